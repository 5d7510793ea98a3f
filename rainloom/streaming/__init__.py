from rainloom.streaming.jobs import stream_ingest, stream_score

__all__ = ["stream_ingest", "stream_score"]
