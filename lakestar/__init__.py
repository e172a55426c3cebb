"""lakestar: a PySpark-native star-schema ELT engine.

Entry points: ``lakestar.plans.job.run`` / ``check``, ``lakestar.plans.loads.load_star``,
``lakestar.plans.warehouse.Warehouse``, ``lakestar.operators.serving`` (dashboard queries),
``lakestar.streaming.start_incremental_load``.
"""

__version__ = "0.1.0"
