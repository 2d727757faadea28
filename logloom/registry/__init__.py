"""Event definitions, contracts, and the (contract, topic0) -> definition routes."""

from . import aave, compound, morpho
from .model import (
    EventDef,
    Registry,
    broadcast_routes,
    contract_definitions,
    define,
    event_definitions,
    route_listing,
    routes,
)

DEFAULT = Registry((aave.CONTRACTS, compound.CONTRACTS, morpho.CONTRACTS))

__all__ = [
    "DEFAULT",
    "EventDef",
    "Registry",
    "broadcast_routes",
    "contract_definitions",
    "define",
    "event_definitions",
    "route_listing",
    "routes",
]
