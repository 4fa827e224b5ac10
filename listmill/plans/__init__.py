"""Named queries over the test tables, with their SQL."""

from . import checks, histories, keyed, nightly, relational, research, reviews, texts  # noqa: F401  they register their queries
from .registry import QUERIES, SQL  # noqa: F401
