from roadspeed.streaming.events import EVENT_SCHEMA, event_values, file_events, publish_events

__all__ = ["EVENT_SCHEMA", "event_values", "file_events", "publish_events"]
