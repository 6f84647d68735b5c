from .incremental import predict_stream, predict_stream_into, stream_texts

__all__ = ["predict_stream", "predict_stream_into", "stream_texts"]
