"""A substitution as a workflow: hooks before and after it, one computed table, and sinks that fail and are tried again by themselves."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from spanloom.operators.substitute import Policy, substitute
from spanloom.plans.stages import settled


@dataclass(frozen=True)
class Outcome:
    """How a concern's sink ended: after how many tries, and with which error if the last one failed."""

    concern: str
    tries: int
    error: str | None = None
    seconds: float = 0.0


@dataclass(frozen=True)
class Concern:
    """What wants a say in a workflow; every part is optional.

    ``before`` sees the documents ahead of the work, ``after`` the table that comes
    of it; both may change it, in the order of the concerns. ``merged`` is given the
    one table that was worked out, as a sink. ``done`` learns how all sinks ended.
    """

    name: str
    before: Callable[[DataFrame], DataFrame] | None = None
    after: Callable[[DataFrame], DataFrame] | None = None
    merged: Callable[[DataFrame], None] | None = None
    done: Callable[[list[Outcome]], None] | None = None


class SinksFailed(RuntimeError):
    """Some sinks failed for good; the others have what they should."""

    def __init__(self, outcomes: list[Outcome]) -> None:
        self.outcomes = outcomes
        super().__init__("; ".join(f"{o.concern}: {o.error}" for o in outcomes if o.error))


@dataclass(frozen=True)
class Workflow:
    """``work`` between the hooks of its concerns."""

    work: Callable[[DataFrame], DataFrame]
    concerns: Sequence[Concern] = field(default_factory=tuple)
    tries: int = 3
    pause: float = 0.0

    def __post_init__(self) -> None:
        names = [c.name for c in self.concerns]
        if len(set(names)) < len(names) or self.tries < 1:
            raise ValueError("concerns need names of their own, and sinks at least one try")

    def run(self, docs: DataFrame) -> DataFrame:
        """The table that was worked out once and handed to every sink.

        It is kept in the checkpoint folder, so a sink that fails is tried again from
        there, alone and up to ``tries`` times, and no other sink is run twice. When
        all have ended, every ``done`` is told, and failures raise together. A sink
        must bear being called again: the ones in ``sources`` add nothing twice.
        """
        for c in self.concerns:
            docs = c.before(docs) if c.before else docs
        out = self.work(docs)
        for c in self.concerns:
            out = c.after(out) if c.after else out
        out = settled(out)
        outcomes = [self._write(c, out) for c in self.concerns if c.merged]
        for c in self.concerns:
            if c.done:
                c.done(outcomes)
        if any(o.error for o in outcomes):
            raise SinksFailed(outcomes)
        return out

    def _write(self, concern: Concern, out: DataFrame) -> Outcome:
        began, error = time.monotonic(), None
        for k in range(1, self.tries + 1):
            try:
                concern.merged(out)
                return Outcome(concern.name, k, None, time.monotonic() - began)
            except Exception as e:  # told to the hooks and raised by run
                error = f"{type(e).__name__}: {str(e)[:500]}"
                time.sleep(self.pause if k < self.tries else 0)
        return Outcome(concern.name, self.tries, error, time.monotonic() - began)


def substitute_through(docs: DataFrame, spans: DataFrame, policy: Policy, concerns: Sequence[Concern], tries: int = 3, **kwargs) -> DataFrame:
    """One substitution through the hooks and sinks of the concerns."""
    return Workflow(lambda d: substitute(d, spans, policy, **kwargs), concerns, tries).run(docs)
