"""Ship UDF code by value so Python workers need no installed package."""

from __future__ import annotations

import sys


def by_value(module_name: str) -> None:
    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[module_name])
    except Exception:  # older cloudpickle: fall back to import by reference
        pass
