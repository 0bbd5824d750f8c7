"""Python code that runs in tasks travels with the task.

Executors need not have this package: functions of a registered module are
pickled by value instead of by the name of the module.
"""

import sys

from pyspark import cloudpickle


def ship_with_tasks(module_name: str) -> None:
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
