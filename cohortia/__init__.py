"""cohortia — product analytics for a feed + messenger app, as Spark DataFrame jobs.

Every public operator takes DataFrames (the two event tables or frames derived
from them) plus explicit dates, and returns a DataFrame.  Nothing is collected
to the driver except scalars of bounded size (a handful of split points or
one-row aggregates), so each operator runs unchanged on a cluster.
"""

from cohortia.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
__version__ = "0.1.0"
