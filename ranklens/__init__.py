"""ranklens: retrieval, learning-to-rank and ranking evaluation as Spark DataFrame operators.

Everything takes DataFrames and returns DataFrames; no operator collects data to
the driver.  The sub-packages are

* ``sources``   – readers for the whitespace text formats (runs, judgments,
  preferences, z-score references, LTR rows, topics) and inputs derived from
  warehouse tables;
* ``functions`` – column-level helpers: tokenisation, the measure catalogue;
* ``operators`` – ranked lists, measures, preferences, scorers, features,
  linear ranking models, nested-article flattening;
* ``plans``     – end-to-end compositions (evaluate a run, build a feature set);
* ``streaming`` – evaluation of runs that arrive as a file stream.
"""

from ranklens.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
