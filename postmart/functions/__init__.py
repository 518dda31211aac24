"""Column-level expressions: parsing, coercion and text cleaning."""

from .parse import (decode_skill_map, encode_json, normalize_list, null_tokens, parse_dict,
                    parse_list, to_decimal, to_timestamp, tri_state_bool)
from .text import (clean_company, clean_platform, clean_schedule, coalesce_title, default_unknown,
                   has_title, is_blank, not_blank, null_key, parse_location, py_strip, skill_match_key,
                   skill_name, sql_trim, text_normalize)

__all__ = [
    "decode_skill_map", "encode_json", "normalize_list", "null_tokens", "parse_dict", "parse_list",
    "to_decimal", "to_timestamp", "tri_state_bool", "clean_company", "clean_platform",
    "clean_schedule", "coalesce_title", "default_unknown", "has_title", "is_blank", "not_blank",
    "null_key", "parse_location", "py_strip", "skill_match_key", "skill_name", "sql_trim",
    "text_normalize",
]
