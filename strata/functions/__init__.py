"""Column -> Column helpers used inside the operators."""

from strata.functions.columns import *  # noqa: F401,F403
