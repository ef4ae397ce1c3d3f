"""Incremental jobs on Structured Streaming."""

from .ingest import annotate_stream, ingest, stream_vcf

__all__ = ["annotate_stream", "ingest", "stream_vcf"]
