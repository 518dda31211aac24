"""postmart: a Spark-native mart for semi-structured job postings.

Raw posting files -> typed staging -> normalized dimensions with surrogate keys, a
postings fact and a posting-to-skill bridge -> data checks -> star schema. Every
operator is a function from DataFrame(s) to DataFrame with column names as parameters.
"""

__version__ = "0.1.0"
