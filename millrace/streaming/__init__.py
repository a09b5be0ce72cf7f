from millrace.streaming.commits import commit_stream
from millrace.streaming.ingest import run_transform, start_transform, stream_transform

__all__ = ["commit_stream", "run_transform", "start_transform", "stream_transform"]
