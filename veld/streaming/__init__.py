"""Streaming: the reference has no stream processing (no watermark, window or state).

Every fitted transform in veld is a stateless projection or a join to a small fitted
table, so it applies unchanged to a streaming DataFrame; ``veld.streaming.scoring``
wires a fitted pipeline to ``readStream`` / ``writeStream`` for continuous batch scoring.
"""
