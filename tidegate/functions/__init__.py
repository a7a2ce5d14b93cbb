from tidegate.functions.columns import (  # noqa: F401
    EPOCH,
    EXPORT_STATUS,
    GOVERNED_SUFFIX,
    KEY_BUCKETS,
    decode,
    effective_change_time,
    flag_set,
    format_watermark,
    key_bucket,
    primary_alias,
    safe_cast,
    timestamp_literal,
    with_suffix,
)
