"""Column -> Column building blocks (no Python UDFs)."""

from lakeloom.functions.text import (  # noqa: F401
    WS_CLASS,
    clean_string,
    clean_text,
    has_text,
    is_blank,
    json_spaced,
    labeled,
    normalize_lower,
    normalize_text,
    strip,
    text_equal,
)
from lakeloom.functions.values import (  # noqa: F401
    clean_list,
    clean_number,
    clean_value_string,
    field,
    is_empty,
    parse_float_text,
    parse_timestamp,
    parse_vote,
    product_id_from_key,
    review_id_from_parts,
    safe_percentage,
    sha256_hex,
    style_json,
    value_type,
)
from lakeloom.functions.vectors import dimension, dot, dot_literal, l2_normalize, norm  # noqa: F401
