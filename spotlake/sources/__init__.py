"""Raw drops, notifications, tables and external sinks."""
