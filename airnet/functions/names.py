"""Header-name helpers (pure metadata, run on the driver over a single header row)."""
from __future__ import annotations

import re

_UNSAFE = re.compile(r"[^A-Za-z0-9_-]")


def unique_names(cells, first: str | None = "datetime", clean: bool = True) -> list[str]:
    """Turn one header row into unique, usable column names.

    * cell 0 becomes ``first`` (when given);
    * cells are trimmed, NULL -> ""; an empty cell becomes ``col_<index>``;
    * with ``clean`` every character outside ``[A-Za-z0-9_-]`` becomes ``_``;
    * the n-th repeat of a name gets suffix ``_<n>``; a suffix that is already taken
      is skipped (``A, A, A_1`` -> ``A, A_1, A_1_1`` would collide, so the loop moves on
      until the name is unused).
    """
    out: list[str] = []
    used: set[str] = set()
    repeats: dict[str, int] = {}
    for idx, cell in enumerate(cells):
        if idx == 0 and first is not None:
            base = first
        else:
            raw = "" if cell is None else str(cell).strip()
            if not raw:
                base = f"col_{idx}"
            else:
                base = _UNSAFE.sub("_", raw) if clean else raw
        name = base
        n = repeats.get(base, 0)
        while name in used:
            n += 1
            name = f"{base}_{n}"
        repeats[base] = n
        used.add(name)
        out.append(name)
    return out
