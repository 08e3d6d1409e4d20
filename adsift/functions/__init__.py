"""Column-expression helpers (all JVM-side, no Python UDF)."""

from adsift.functions.exprs import (  # noqa: F401
    form_complete, is_one_of, iso_millis, java_split, map_get_or_else, map_value,
    strip_id_prefix, tag_value, to_text,
)
