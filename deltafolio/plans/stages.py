"""Run control: numbered stages of a manual, in order, from one to another, stopping at the first that fails."""

from __future__ import annotations

import re
import traceback
from collections.abc import Callable, Iterable
from typing import Any, NamedTuple


class Stage(NamedTuple):
    """prefix: two digits that order the stages and name them in ``first`` and ``last``."""

    prefix: str
    name: str
    run: Callable[..., Any]


class Outcome(NamedTuple):
    manual: str
    stage: str
    ok: bool
    error: str | None = None


#: The stage that asks the model.
AI = "05"


def chosen(stages: Iterable[Stage], first: str | None = None, last: str | None = None, skip_ai: bool = False) -> list[Stage]:
    """Stages in the order of their prefixes, between two of them (ends included, compared as text); a prefix stands once."""
    ordered = sorted(stages, key=lambda s: s.prefix)
    for s in ordered:
        if not re.fullmatch("[0-9]{2}", s.prefix):
            raise ValueError(f"stage {s.name} has no prefix of two digits")
    if len({s.prefix for s in ordered}) < len(ordered):
        raise ValueError("two stages have one prefix")
    return [s for s in ordered if (first is None or s.prefix >= first) and (last is None or s.prefix <= last) and not (skip_ai and s.prefix == AI)]


def run_manual(manual: str, stages: Iterable[Stage], first: str | None = None, last: str | None = None, skip_ai: bool = False, **options: Any) -> list[Outcome]:
    """Outcomes of the chosen stages; what comes after a failure is not run. Each stage gets the manual, what the last one
    returned and the options."""
    out, made = [], None
    for stage in chosen(stages, first, last, skip_ai):
        try:
            made = stage.run(manual, made, **options)
        except Exception:  # a stage may fail in any way; its trace is the outcome
            out.append(Outcome(manual, stage.name, False, traceback.format_exc()))
            break
        out.append(Outcome(manual, stage.name, True))
    return out


def run_all(manuals: dict[str, Iterable[Stage]], **options: Any) -> list[Outcome]:
    """Every manual, whatever becomes of the others."""
    return [x for manual, stages in manuals.items() for x in run_manual(manual, stages, **options)]
