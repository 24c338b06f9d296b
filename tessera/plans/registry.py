"""All registered queries of the engine's own operators, with the SQL that each must equal."""

from __future__ import annotations

from tessera.plans import acceptance, draws, kernel, measures, places, points, reports, resolves, scalars, selections, stores, streams, supplies

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
for _module in (resolves, places, supplies, acceptance, draws, stores, measures, selections, points, reports, scalars, kernel, streams):
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES
FLAGSHIP = "target_deficit"
