from tidemark.streaming.landed import stream_resource

__all__ = ["stream_resource"]
