"""Streaming use of fitted state.

The reference has no streaming operator (every source is a one-shot CSV
read), so nothing stateful is rebuilt here. What carries over is scoring:
a fitted ``FeaturePipelineModel`` and a fitted model are pure projections
whose statistics are literals, so they apply unchanged to a ``readStream``
frame, with no state store and no shuffle.
"""

from tabreg.streaming.scoring import score, score_stream_to_table

__all__ = ["score", "score_stream_to_table"]
