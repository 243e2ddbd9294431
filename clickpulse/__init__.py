"""Mall clickstream and ad-click analytics on Spark DataFrames.

Batch jobs live in :mod:`clickpulse.operators`, the stream jobs in
:mod:`clickpulse.streaming`; both share the column helpers of
:mod:`clickpulse.functions` and the readers/writers of :mod:`clickpulse.sources`.
"""

from clickpulse.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
