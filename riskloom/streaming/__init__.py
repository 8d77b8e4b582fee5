"""Structured Streaming entry points.

The reference has no streaming operator. Everything on the scoring path
(intake projections, recipes, rule scores, ranking, triage) is a stateless
per-row projection, so the same functions run unchanged on a ``readStream``
frame; this package only wires a source and a sink around them.
"""
