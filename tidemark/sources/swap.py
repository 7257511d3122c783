"""Making a replayed table the live one, and back again."""

from __future__ import annotations

from collections.abc import Callable

LIVE = "live"
#: The names that the live table's place is exchanged with: v2 comes in from a replay, v1 is what was live before.
SLOTS = ("v1", "v2")


def moves(target: str, names: dict[str, str], exists: Callable[[str], bool]) -> list[tuple[str, str]]:
    """The renames that bring `target` to the live name: the live table steps into the other slot, so that one has to be empty."""
    if target not in SLOTS:
        raise ValueError(f"{target!r} is none of {SLOTS}")
    aside = SLOTS[1 - SLOTS.index(target)]
    for slot, wanted in ((target, True), (aside, False)):
        if exists(names[slot]) is not wanted:
            raise ValueError(f"{names[slot]} is {'missing' if wanted else 'in the way'}")
    return [(names[LIVE], names[aside]), (names[target], names[LIVE])]


def switch(target: str, names: dict[str, str], exists: Callable[[str], bool], rename: Callable[[str, str], None], differs: Callable[[], bool], force: bool = False) -> list[tuple[str, str]]:
    """Carry the renames out. A v2 that differs from the live table is refused unless forced; rolling back is not held up by a comparison."""
    steps = moves(target, names, exists)
    if target == SLOTS[1] and not force and differs():
        raise ValueError(f"{names[target]} differs from {names[LIVE]}")
    for old, new in steps:
        rename(old, new)
    return steps
