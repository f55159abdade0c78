"""Text analytics and training-text preparation as Spark jobs.

Some operators run Python inside tasks.  Workers on the driver's machine find
the package where the driver does, by the path set here, whatever folder the
session was started in; to other machines it is shipped as usual, with ``--py-files``.
"""

import os

from pyspark import SparkContext

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _with_root(paths: str) -> str:
    parts = [p for p in paths.split(os.pathsep) if p]
    return os.pathsep.join(parts if _ROOT in parts else [*parts, _ROOT])


os.environ["PYTHONPATH"] = _with_root(os.environ.get("PYTHONPATH", ""))
if SparkContext._active_spark_context is not None:
    _set = SparkContext._active_spark_context.environment
    _set["PYTHONPATH"] = _with_root(_set.get("PYTHONPATH", ""))
