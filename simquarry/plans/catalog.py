"""All registered queries: importing the families fills the register."""

from simquarry.plans import ingest, intake, retention, streams, structure, transfer  # noqa: F401
from simquarry.plans.registry import ORACLE, QUERIES  # noqa: F401
