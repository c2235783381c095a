"""searchlens: video-search analytics on Spark.

Jobs (``plans``) compute hot-search lists, most played videos, time-of-day
content preferences, heat and voice scores from play/browse logs and a
video catalog; they are built from DataFrame operators (``sources``,
``operators``, ``functions``, ``sinks``, ``streaming``). ``plans.jobs`` and
``cli`` run them end to end.
"""
