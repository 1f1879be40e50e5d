"""Column-name rules. Names live on the driver, so this is plain Python."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

# Characters trimmed from the edges of text and names.
BLANKS = " \t\r\n"


def clean_name(text: object) -> str:
    """Lower-case identifier made of letters, digits and single underscores."""
    name = re.sub(r"[\W_]+", "_", str(text).strip(BLANKS).lower()).strip("_")
    if not name:
        return "column"
    return f"x_{name}" if name[0] in "0123456789" else name


def uniquify(names: Sequence[str], reserved: Iterable[str] = ()) -> list[str]:
    """Make names distinct: a repeat gets the first free suffix _1, _2, ...

    ``reserved`` names are already in use. Spark resolves columns without regard
    to case, so two names that differ in case only count as equal.
    """
    seen = {name.lower() for name in reserved}
    taken = seen | {name.lower() for name in names}
    next_suffix: dict[str, int] = {}
    out = []
    for name in names:
        key = name.lower()
        if key in seen:
            number = next_suffix.get(key, 1)
            while f"{key}_{number}" in taken:
                number += 1
            next_suffix[key] = number + 1
            name = f"{name}_{number}"
            taken.add(name.lower())
        seen.add(name.lower())
        out.append(name)
    return out


def free_name(name: str, existing: Iterable[str]) -> str:
    """One new name next to existing ones; suffixes start at _2."""
    used = {other.lower() for other in existing}
    candidate, number = name, 1
    while candidate.lower() in used:
        number += 1
        candidate = f"{name}_{number}"
    return candidate


def clean_names(names: Sequence[str]) -> list[str]:
    return uniquify([clean_name(name) for name in names])
