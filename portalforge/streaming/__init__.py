"""Incremental runs with Structured Streaming.

The reference has no streaming logic; what arrives over time are the
per-sample result files.  ``maf_stream`` merges MAF files as they land in a
folder, with the same filter and template as the batch job.
"""

from portalforge.streaming.maf_stream import start_maf_stream

__all__ = ["start_maf_stream"]
