"""reshift: find reserved cloud capacity that goes unused and propose where to move it.

A PySpark library: hourly usage lines and a reservation inventory in, two
date-partitioned tables out (suggested moves, and the reservation each move
draws on). See README.md for the stage map and scale notes.
"""

from reshift.params import RunParams  # noqa: F401
from reshift.plans.job import RunResult, run  # noqa: F401
from reshift.plans.stages import Stages  # noqa: F401
