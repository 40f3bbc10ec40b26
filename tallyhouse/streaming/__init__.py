from tallyhouse.streaming.ingest import ingest_available, stream_dumps, stream_hourly, tally_new

__all__ = ["ingest_available", "stream_dumps", "stream_hourly", "tally_new"]
