"""All registered queries; importing the family modules fills the registry."""

from tickloom.plans import documents, matrices, portfolios, prices, randoms, scans, tables  # noqa: F401
from tickloom.plans.registry import QUERIES, SQL  # noqa: F401
