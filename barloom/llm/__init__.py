"""Operators of a training-data pipeline. Nothing else in the library imports them.

Their Python code runs in tasks, so it travels with the tasks.
"""

from barloom.shipping import ship_with_tasks

ship_with_tasks(__name__)
