from fleetlens.sources.tables import load
from fleetlens.sources.fixtures import (
    trip_events, pre_post_events, event_dim, trip_event_extra, event_classification_type,
    event_classification, company_settings, company, shard_server,
)

__all__ = [
    "load", "trip_events", "pre_post_events", "event_dim", "trip_event_extra",
    "event_classification_type", "event_classification", "company_settings", "company", "shard_server",
]
