"""Assets, what they need, when they run, and what a first run should start."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass


@dataclass(frozen=True)
class Asset:
    """What one job makes: its tables, the assets that have to be there before, and its schedule."""

    name: str
    makes: tuple[str, ...]
    needs: tuple[str, ...] = ()
    cron: str = ""
    zone: str = "UTC"


# Names, tables and schedules of the assets, and what the gold tables are made from.
ASSETS = {
    a.name: a
    for a in (
        Asset("fx_rates", ("fx_rates",), (), "30 16 * * 1-5", "Europe/Berlin"),
        Asset("sanctions", ("sanctions_targets", "sanctions_names"), (), "15 6 * * *", "Europe/London"),
        Asset("gold", ("crypto_ohlcv_1m", "card_auth_daily", "sanctions_hits"), ("fx_rates", "sanctions"), "20 * * * *"),
    )
}
UPSTREAM = {
    "sanctions_names": ("sanctions_targets",),
    "card_auths": ("fx_rates",),
    "crypto_ohlcv_1m": ("trades",),
    "card_auth_daily": ("card_auths",),
    "sanctions_hits": ("card_auths", "sanctions_names", "sanctions_targets"),
}


def first_run(made: set[str]) -> list[tuple[str, str]]:
    """(run key, asset) to start: assets of which a table was never made, once all they need is there. The same request has the same key, so
    asking again starts nothing twice."""
    done = {a.name for a in ASSETS.values() if set(a.makes) <= made}
    return [(f"first-run-{a.name}", a.name) for a in ASSETS.values() if a.name not in done and set(a.needs) <= done]


def lineage(table: str) -> set[str]:
    """All tables that a table is made from, directly or not."""
    found: set[str] = set()
    left = list(UPSTREAM.get(table, ()))
    while left:
        if (one := left.pop()) not in found:
            found.add(one)
            left += UPSTREAM.get(one, ())
    return found


def materialise(asset: str, jobs: dict[str, Callable[[], object]], made: set[str]) -> object:
    """Run the asset's job, if what it needs was made; its tables count as made after that."""
    if missing := [n for n in ASSETS[asset].needs if not set(ASSETS[n].makes) <= made]:
        raise ValueError(f"{asset} needs {', '.join(missing)}")
    result = jobs[asset]()
    made.update(ASSETS[asset].makes)
    return result
