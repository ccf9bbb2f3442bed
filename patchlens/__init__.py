"""patchlens: Spark-native security-advisory and host-exposure analytics.

Monthly CVRF bulletins are read with Spark's XML source, shredded into
staging tables with ``explode``, turned into a vulnerability mart and a
patch catalog, and joined to host inventory to list recommended patches
and open vulnerabilities per host.  Every step is a DataFrame plan; the
generic operators take column names so they run on any table.
"""

__version__ = "0.1.0"
