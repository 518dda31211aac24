"""Page extraction and archives."""

import gzip
import io

import numpy as np
import pytest

from postmart.llm import extraction, warc


@pytest.mark.parametrize("html, want", [
    ("", []), ("a < b & c <", ["a < b & c <"]), ("<p class='ad'>buy<p>real<script>if(a<b){'</p>'}</script> more", ["real more"]),
    ("<div class=ad>x<article><p>hello</article>", ["hello"]), ('<div "unbalanced>x</div> y', ["x", "y"]),
    ("<body class=has-sidebar><div id=header>H</div><ul class=menu><li>Home</ul><div class=content><h2>T &amp; m</h2><p>One"
     "<p>Two<br>three <table><tr><td>a</td><td>b</td></tr></table><div class=cookie-notice>We <div>use</div> x</div>tail"
     "</div><div class=comments><article class=comment><p>nice</article></div><form><p>mail</form><footer>f</body>",
     ["T & m", "One", "Two three", "a b", "tail"]),
    ("<!-- <p>no</p> --><style>p{}</style><title>T</title><main><p>yes&nbsp; &#233;\n x</p></main><aside>s</aside>", ["yes é x"]),
    ("<article><header><h1>T</h1></header><p>a</p><nav>n</nav><section class='reader-comments'><p>c</p></section></article>",
     ["T", "a"]),
    ("<p hidden>h</p><p style='display: none'>d</p><p aria-hidden='true'>i</p><p>s</p><!-- open", ["s"]),
])
def test_lines(html, want):
    assert [t for t, _ in extraction.lines(html)] == want


def brute_lcs(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            rows[i + 1][j + 1] = rows[i][j] + 1 if a[i] == b[j] else max(rows[i][j + 1], rows[i + 1][j])
    return rows[-1][-1]


def test_shared_lines_are_a_longest_common_subsequence():
    rng = np.random.RandomState(0)
    for _ in range(300):
        a, b = (rng.randint(0, 6, rng.randint(0, 15)).astype(np.uint64) for _ in range(2))
        places = extraction.shared(a, b)
        assert len(places) == brute_lcs(a.tolist(), b.tolist()) and places == sorted(set(places))
        rest = iter(b.tolist())
        assert all(x in rest for x in a[places].tolist())


def make(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "1 AS key", "'x' AS text", "'x' AS number", "'x' AS payload_digest", "'x' AS gone")


def test_main_text(spark):
    def page(art):
        return f"<body><div>Top story links</div><div>{art}</div><p>Copyright Example Site</p></body>"
    rows = [(k, f"http://h/a/{k:03d}", page(f"unique line {k} with text")) for k in range(60)]
    rows += [(100, None, None), (101, "bad:[", ""), (102, "http://c/1", page("copy")), (103, "http://c/2", page("copy")),
             (None, "http://d/1", "<article><p>Kept by</p><p>its article</p></article>"),
             (104, "http://d/2", "<article><p>Kept by</p><p>its article</p></article>"),
             (105, "http://e/1", "<p>" + "word " * 200000 + "</p>")]
    rows += [rows[5]]
    got = {}
    for r in extraction.main_text(make(spark, rows)).collect():
        assert r.n_chars == len(r.text)
        got.setdefault(r.page_id, []).append(r.text)
    assert len(got[5]) == 2 and got[3] == ["unique line 3 with text"] and got[59] == ["unique line 59 with text"]
    assert got[100] == got[101] == [""]
    assert got[102] == got[103] == ["Top story links\n\ncopy\n\nCopyright Example Site"]  # copies say nothing of each other
    assert got[None] == got[104] == ["Kept by\n\nits article"]
    assert got[105] == [("word " * 200000).strip()]
    assert extraction.main_text(make(spark, [])).count() == 0


def test_runs_of_copies_meet_other_pages(spark):
    """Copies under neighbouring paths lose the lines that the other pages of their host share."""
    def page(art):
        return f"<body><div>Top story links</div><div>{art}</div><p>Copyright Example Site</p></body>"
    rows = [(k, f"http://h/a/{k:03d}", page(f"own line {k} of a page")) for k in range(5)]
    rows += [(10 + k, f"http://h/b/{k:03d}", page("the same article again")) for k in range(600)]
    rows += [(900 + k, f"http://h/c/{k:03d}", page(f"last line {k} of a page")) for k in range(5)]
    got = {r.page_id: r.text for r in extraction.main_text(make(spark, rows)).collect()}
    assert len(got) == 610 and got[0] == "own line 0 of a page" and got[904] == "last line 4 of a page"
    assert {got[10 + k] for k in range(600)} == {"the same article again"}


def test_archives(spark):
    rows = [(1, "http://a/\r\nb", "<p>x</p>\r\n\r\nWARC/1.1\r\n\r\n"), (2, None, None), (3, "u", ""), (4, "ü", "é\x00<p>"),
            (5, "u", "é\x00<p>"), (5, "u", "é\x00<p>"), (None, "n", "é\x00<p>"), (7, "7", "z" * 300000)]
    rows += [(100 + k, "many", "same") for k in range(3000)]
    got = sorted((r.page_id is None, r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes)
                 for r in warc.round_trip(make(spark, rows)).collect())
    want = [(1, "response", None, 24), (2, "revisit", 3, 0), (3, "response", None, 0), (4, "revisit", 5, 6),
            (5, "response", None, 6), (5, "revisit", 5, 6), (7, "response", None, 300000)]
    want += [(100 + k, "revisit", 3099, 4) for k in range(2999)] + [(3099, "response", None, 4)]
    assert got == [(False, *w) for w in want] + [(True, 0, "revisit", 5, 6)]
    only = [r for r in warc.round_trip(make(spark, rows[:7]), least_bytes=1).collect() if r.payload_bytes == 0]
    assert [r.record_type for r in only] == ["response", "response"]
    assert warc.round_trip(make(spark, [])).count() == 0


def test_revisits_hold_no_payload(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archives(make(spark, [(1, "u", "same"), (2, "u", "same")]), path)
    text = b"".join(gzip.decompress(p.read_bytes()) for p in tmp_path.glob("archive/part-*"))
    assert text.count(b"\r\n\r\nsame\r\n\r\n") == 1 and text.count(b"WARC-Type: revisit") == 1
    with pytest.raises(ValueError):
        warc.parse(io.BytesIO(text[:-3]))
