"""What a constrained cube consists of, checked when it is made."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import combinations, product

AGGREGATES = frozenset({"sum", "min", "max", "count", "avg", "stddev", "count_distinct", "approx_count_distinct", "percent", "percentile", "hist_percentile", "num_missing", "num_non_missing", "collect_set"})
#: Aggregates that need a partition level below the cells, and are allowed with one only.
TWO_LEVEL = frozenset({"percentile_of_percentages", "count_distinct_partitioned"})


class SpecError(ValueError):
    """A specification that contradicts itself."""


@dataclass(frozen=True)
class Fact:
    """One output fact. Input: expr, else matches (0/1 from a pattern on column), else column (the name by default), under ``when``.

    Cleaning, the first that is given: exclude_zeros, between (outside: null), default (for nulls). Percentiles may be taken of
    values rounded to places (round_first), hist_percentile also of multiples of a step (error).
    """

    name: str
    agg: str = "sum"
    column: str | None = None
    expr: str | None = None
    matches: str | None = None
    when: str | None = None
    args: tuple[str, ...] = ()
    pcts: tuple[int, ...] = ()
    accuracy: int = 5000
    exact: bool = False
    round_first: int | None = None
    error: float | None = None
    bins: int = 100
    rsd: float = 0.03
    exclude_zeros: bool = False
    between: tuple[float, float] | None = None
    default: float | None = None
    exclude: bool = False

    def __post_init__(self) -> None:
        if self.agg not in AGGREGATES | TWO_LEVEL:
            raise SpecError(f"{self.name}: unknown aggregate {self.agg}")
        if self.agg in ("percentile", "hist_percentile", "percentile_of_percentages") and not (self.pcts and all(isinstance(p, int) and 0 < p < 100 for p in self.pcts)):
            raise SpecError(f"{self.name}: percentiles are whole numbers between 0 and 100")
        if self.agg in ("percent", "percentile_of_percentages") and not (self.matches or self.expr):
            raise SpecError(f"{self.name}: {self.agg} needs a pattern")
        if self.agg == "hist_percentile" and not 10 <= self.bins <= 10_000:
            raise SpecError(f"{self.name}: bins must lie in [10, 10000]")
        if self.error is not None and (self.agg != "hist_percentile" or self.error <= 0 or self.round_first is not None):
            raise SpecError(f"{self.name}: an error step is above 0, for hist_percentile only, and not beside round_first")


@dataclass(frozen=True)
class Derived:
    """A column made from the finished facts; outside ``between`` (either end may be None) it is null."""

    name: str
    expr: str
    between: tuple[float | None, float | None] | None = None


@dataclass(frozen=True)
class CubeSpec:
    """Dimensions, constraints on their combinations, facts, and what is done before and after."""

    facts: tuple[Fact, ...]
    dims: tuple[str, ...] = ()
    hierarchies: tuple[tuple[str, ...], ...] = ()
    xor_groups: dict[str, tuple[str, ...]] = field(default_factory=dict)
    mandatory: tuple[str, ...] = ()
    grouping_sets: tuple[tuple[str, ...], ...] = ()
    min_depth: int = 0
    max_depth: int = 99
    max_depth_by_dim: dict[str, int] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    null_sentinel: str = "__NULL__"
    ignore_null_groupings: bool = True
    filters: tuple[str, ...] = ()
    post: tuple[Derived, ...] = ()
    post_filters: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if not self.facts:
            raise SpecError("a cube needs facts")
        names = [f.name for f in self.facts]
        if len({*names}) < len(names):
            raise SpecError("facts of one name")
        if clash := {*names} & {*self.all_dims}:
            raise SpecError(f"both a dimension and a fact: {sorted(clash)}")
        if self.grouping_sets and (self.dims or self.hierarchies):
            raise SpecError("grouping sets exclude dimensions")
        if not self.all_dims:
            raise SpecError("a cube needs dimensions")
        two = {f.name for f in self.facts if f.agg in TWO_LEVEL}
        if bool(two) != bool(self.partition_by) or self.partition_by and len(two) < len(names):
            raise SpecError("two-level facts need partition columns, and allow no others beside them")
        known = {*self.all_dims}
        for what, cols in (("mandatory", self.mandatory), ("max_depth_by_dim", self.max_depth_by_dim), *self.xor_groups.items()):
            if missing := {*cols} - known:
                raise SpecError(f"{what}: no such dimension {sorted(missing)}")

    @property
    def all_dims(self) -> tuple[str, ...]:
        cols = [*self.dims, *(c for h in self.hierarchies for c in h), *(c for s in self.grouping_sets for c in s)]
        return tuple(dict.fromkeys(cols))

    @property
    def base_dims(self) -> tuple[str, ...]:
        """What depth counts: simple dimensions, each hierarchy's head, and columns of explicit sets."""
        return tuple(dict.fromkeys([*self.dims, *(h[0] for h in self.hierarchies), *(c for s in self.grouping_sets for c in s)]))

    def sets(self) -> list[tuple[str, ...]]:
        """The grouping sets that all constraints allow, none of the others is ever made."""
        if self.grouping_sets:
            found = {frozenset(s) for s in self.grouping_sets}
        else:
            tails = {c for h in self.hierarchies for c in h}
            simple = [d for d in self.dims if d not in tails]
            prefixes = [[frozenset(h[:k]) for k in range(len(h) + 1)] for h in self.hierarchies]
            free = [frozenset(c) for k in range(len(simple) + 1) for c in combinations(simple, k)]
            found = {frozenset().union(f, *p) for f in free for p in product(*prefixes)}
        order = {d: i for i, d in enumerate(self.all_dims)}
        kept = [tuple(sorted(s, key=order.__getitem__)) for s in found if self.allows(s)]
        return sorted(kept, key=lambda s: (len(s), [order[c] for c in s]))

    def allows(self, chosen: frozenset[str] | Sequence[str]) -> bool:
        chosen = frozenset(chosen)
        depth = len(chosen & {*self.base_dims})
        return (
            self.min_depth <= depth <= self.max_depth
            and all(len(chosen & {*g}) <= 1 for g in self.xor_groups.values())
            and {*self.mandatory} <= chosen
            and all(d not in chosen or len(chosen) + len(self.partition_by) <= n for d, n in self.max_depth_by_dim.items())
        )
