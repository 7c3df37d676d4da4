"""Scalar column functions."""

from runledger.functions.scalar import (  # noqa: F401
    cell_display,
    component_type,
    default_batch_id,
    duration_text,
    file_type,
    guarded_ratio,
    is_non_blank,
    json_encode,
    log_level,
    note_text,
    object_uri,
    safe_name,
    step_display_name,
    try_int,
    ttl_epoch,
)
