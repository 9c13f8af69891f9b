"""DataFrame-to-DataFrame operators. Nothing here collects.

Only ``lineage.collapse`` and ``lineage.graph``, which store the links they read several
times, and ``numbering.place_in_group``, which stores its ranges, run jobs on their own.
"""
