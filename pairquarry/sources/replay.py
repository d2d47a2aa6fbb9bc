"""Transports without a network, for trying the paged and the cursor source."""

import json
import os
from bisect import bisect_left
from pathlib import Path


def pages(resource: str, page: int):
    """Five pages of two numbered records."""
    return [{"id": 10 * page + i, "resource": resource} for i in range(2)] if page <= 5 else [], page < 5


#: Numbers of the pages below a folder, in order, as long as the folder isn't changed.
_LISTED: dict[Path, tuple[int, list[int]]] = {}


def _left(root: Path, cursor: str | None) -> list[int]:
    """The next two pages from the cursor on, as far as there are so many."""
    changed = os.stat(root).st_mtime_ns
    if _LISTED.get(root, (0,))[0] != changed:
        _LISTED[root] = changed, sorted(int(d.removeprefix("page=")) for d in os.listdir(root) if d.startswith("page="))
    known = _LISTED[root][1]
    at = bisect_left(known, int(cursor or 0))
    if len(known) - at < 2:  # the end is looked at anew: a page may have come within the clock's grain
        del _LISTED[root]
        known = sorted(int(d.removeprefix("page=")) for d in os.listdir(root) if d.startswith("page="))
        at = bisect_left(known, int(cursor or 0))
    return known[at : at + 2]


def _lines(root: Path, page: int) -> list[bytes]:
    return [line for f in sorted(root.glob(f"page={page}/part-*")) for line in f.read_bytes().splitlines()]


def chain(resource: str, cursor: str | None):
    """Pages landed as JSON lines in folders page=N below resource, a folder that the driver and all tasks see. A cursor names a page
    or, at the chain's end, the place after the last one, where a page may appear later."""
    root = Path(resource.removeprefix("file:"))
    left = _left(root, cursor)
    if not left:
        return [], cursor, False, None
    return [json.loads(line) for line in _lines(root, left[0])], str(left[0] + 1), len(left) > 1, None


def following(resource: str, cursor: str | None):
    """What chain() says of a page, with the number of its records instead of them."""
    root = Path(resource.removeprefix("file:"))
    left = _left(root, cursor)
    return (len(_lines(root, left[0])), str(left[0] + 1), len(left) > 1, None) if left else (0, cursor, False, None)
