from lapdeck.functions.columns import (  # noqa: F401
    duration_seconds, event_key, nan_to_null, normalise_missing, race_id,
    struct_order, upper_in_domain,
)
