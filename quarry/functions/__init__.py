"""Column-level helpers (all built-in Spark expressions unless noted)."""

from quarry.functions.columns import (as_col, bytes_to_string, coerce_double, composite_key, contains,
                                      first_char_partition, fixed_width, format_decimals, java_trim,
                                      parse_date, parse_number, reformat_date, string_to_bytes)
from quarry.functions.tokenize import (TOKENIZERS, get_tokenizer, head_and_rest, java_split, regex_words,
                                       split_collapse, split_escaped, split_keep_all, split_lines,
                                       split_tokenizer, split_whitespace)

__all__ = [
    "as_col", "bytes_to_string", "coerce_double", "composite_key", "contains", "first_char_partition",
    "fixed_width", "format_decimals", "java_trim", "parse_date", "parse_number", "reformat_date",
    "string_to_bytes", "TOKENIZERS", "get_tokenizer", "head_and_rest", "java_split", "regex_words",
    "split_collapse", "split_escaped", "split_keep_all", "split_lines", "split_tokenizer", "split_whitespace",
]
