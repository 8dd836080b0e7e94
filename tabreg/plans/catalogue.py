"""All registered queries and their oracle SQL, merged from the family modules."""

from __future__ import annotations

import importlib

_FAMILIES = ["q_profile", "q_prep", "q_models", "q_eval", "q_tune", "q_frames", "q_encode", "q_closed"]


def _load():
    queries, oracles = {}, {}
    for fam in _FAMILIES:
        try:
            mod = importlib.import_module(f"tabreg.plans.{fam}")
        except ModuleNotFoundError as e:
            if e.name == f"tabreg.plans.{fam}":
                continue
            raise
        queries.update(mod.QUERIES)
        oracles.update(mod.ORACLES)
    return queries, oracles


def queries():
    return _load()[0]


def oracles():
    return _load()[1]
