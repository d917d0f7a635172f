"""Streaming: new raw drops processed as they arrive (Structured Streaming)."""
