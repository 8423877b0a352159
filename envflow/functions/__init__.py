"""Column functions; none of them runs Python on the executors."""

from envflow.functions.scalars import *  # noqa: F403
