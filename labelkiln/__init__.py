"""labelkiln: labelled-text classification data pipelines as Spark jobs.

Layers:
  sources/    task files (TSV, JSONL, CSV, Parquet records) -> one example schema
  functions/  Column-level helpers (hash keys, activations, grids, safe math)
  operators/  DataFrame -> DataFrame operators (ordering, features, sampling,
              metrics, selection, models)
  plans/      the end-to-end flows and the query catalog checked against SQL
  streaming/  the stateless scoring operators applied to a streaming source
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Python UDFs defined here are pickled with their code (and the helpers
    they call), so executors need no installed copy of this package."""
    import sys
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # pragma: no cover - older cloudpickle
        pass


_ship_by_value()
