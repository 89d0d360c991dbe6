"""tidemark: edit-event stream and pageview analytics on Spark.

Transformations are ``DataFrame -> DataFrame`` and are shared by batch and
stream; only ``sources``, ``sinks``, ``streaming`` and ``plans.jobs`` do I/O.
"""

__version__ = "0.1.0"
