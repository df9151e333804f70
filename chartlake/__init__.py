"""chartlake: a Spark-native star-schema engine for weekly charts.

Entry points:

* ``chartlake.plans.warehouse`` -- ``build_star`` / ``write_star`` /
  ``build_warehouse`` (full load), ``refresh_warehouse`` (incremental load),
  ``read_star`` (open a written warehouse), ``create_warehouse``.
* ``chartlake.plans.marts`` -- the analytical marts over a ``Star``.
* ``chartlake.plans.chart_tables`` -- chart-ready tables built on the marts.
* ``chartlake.operators`` -- loaders, incremental marks, range operators,
  data-quality rules.
* ``chartlake.sources.staging`` -- landed JSON / CSV readers and staging
  sinks; ``chartlake.streaming.chart_stream`` -- the streaming load.
* ``chartlake.config`` -- ``MartConfig`` / ``LoadConfig`` and the fixed rule
  values.
"""
