"""Intentionally empty: every table in this data model is a bounded batch.

The model has no watermarks, event-time windows or keyed state. Repeated batches arrive
through the append-only load in ``ledgerlake.plans.lake``.
"""
