"""Query plans over the driver's tables. Importing the area modules
registers their queries."""

import importlib

AREAS = ["q_reports", "q_scalars", "q_dedupe", "q_joins", "q_composite", "q_sources", "q_layout"]


def load_all() -> None:
    for m in AREAS:
        try:
            importlib.import_module(f"shelfwise.plans.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"shelfwise.plans.{m}":
                raise
