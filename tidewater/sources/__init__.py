from tidewater.sources.readers import (  # noqa: F401
    read_service_events, read_service_partition, read_tables, normalise_timestamps,
)
