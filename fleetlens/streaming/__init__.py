from fleetlens.streaming.stream import run_stream, stage_chunks

__all__ = ["run_stream", "stage_chunks"]
