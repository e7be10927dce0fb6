"""SQL pieces that several oracles share."""

from __future__ import annotations

from ..functions.text import SPACE


def collapse(x: str) -> str:
    return f"regexp_replace(regexp_replace(lower({x}), '{SPACE}+', ' ', 'g'), '^ | $', '', 'g')"


def words(x: str) -> str:
    return f"len(list_filter(regexp_split_to_array({x}, '{SPACE}+'), lambda x: x <> ''))"


def strip(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '^{SPACE}+|{SPACE}+$', '', 'g')"


def blank(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '{SPACE}', '', 'g') = ''"


def listed(values: list[str]) -> str:
    return ", ".join(f"'{x}'" for x in values)
