"""One aggregate of the rostered claims, and every result as a roll-up of it.

Cost tables, inpatient, emergency, nursing and outpatient results all sum the same rostered claim lines, by fewer or more of the same
columns. A ``ClaimLattice`` knows the finest grain that any of them asks for. Where results are staged it sums the claims to that
grain once and stores it; each result then is a small group-by of the stored rows, and results at a coarser grain start from the
smallest stored one that holds their columns. Where nothing is staged, a result sums the claims at its own grain, in one pass.
Only sums and counts are measures, so a roll-up equals the aggregate of the claims themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from popledger.operators.claims import MEASURES, agg_claims

# columns by which some result sums medical or pharmacy claims
MEDICAL_GRAIN = [
    "member_id", "elig_status_1", "memmos", "prm_line", "caseadmitid", "facilitycaseid", "providerid", "dischargestatus", "prm_util_type",
    "prv_net_aco_yn",
]
PHARMACY_GRAIN = ["member_id", "elig_status_1", "memmos", "prm_line", "prv_net_aco_yn"]
#: The status a claim line carries itself, where the claim tables have one.
OWN_STATUS = "claim_status"


class ClaimLattice:
    """Sums of one claim table over the rostered members, at any grain up to ``dims``.

    ``keep`` writes a table under a name and reads it back; without it nothing is stored."""

    def __init__(
        self, claims: DataFrame, windows: DataFrame, members: DataFrame, dims: Sequence[str], basis: str, name: str,
        keep: Callable[[DataFrame, str], DataFrame] | None = None,
    ):
        own = "elig_status_1" in claims.columns
        self.claims = claims.withColumnRenamed("elig_status_1", OWN_STATUS) if own else claims
        self.dims = [*dims, *([OWN_STATUS] if own else [])]
        self.windows, self.basis, self.name, self.keep = windows, basis, name, keep
        self.roster = members.select("member_id", "time_period", "elig_status_1", "memmos")
        self._stored: list[tuple[frozenset[str], DataFrame]] = []

    def _summed(self, dims: Sequence[str], where: Column | None, measures: dict[str, str]) -> DataFrame:
        return agg_claims(self.claims, self.windows, dims, where=where, basis=self.basis, measures=measures, roster=self.roster)

    def store(self, dims: Sequence[str]) -> None:
        """Store the sums at a grain, for roll-ups that need no more columns."""
        if self.keep:
            rows = self.at(dims) if self._stored else self._summed(dims, None, MEASURES)
            self._stored.append((frozenset(dims), self.keep(rows, "_".join([self.name, *(["grain"] if len(dims) == len(self.dims) else dims)]))))

    def at(
        self, dims: Sequence[str], measures: Sequence[str] | None = None, where: Column | None = None, needs: Sequence[str] = (), final: bool = True,
    ) -> DataFrame:
        """Sums by window and ``dims``; ``where`` may read the columns in ``needs`` as well. ``claim_lines`` counts the lines.

        A caller that sums the rows again says so by ``final=False``: stored rows then come as they are, several to a key."""
        unknown = ({*dims} | {*needs}) - {*self.dims}
        if unknown:
            raise ValueError(f"{self.name} has no {', '.join(sorted(unknown))}")
        measures = list(MEASURES) if measures is None else list(measures)
        if self.keep and not self._stored:
            self.store(self.dims)
        fit = [(len(have), i) for i, (have, _) in enumerate(self._stored) if {*dims} | {*needs} <= have]
        if not fit:
            return self._summed(dims, where, {m: MEASURES[m] for m in measures})
        rows = self._stored[min(fit)[1]][1]
        rows = rows if where is None else rows.where(where)
        if not final:
            return rows.select("time_period", *dims, *measures, "claim_lines")
        return rows.groupBy("time_period", *dims).agg(*[F.sum(m).alias(m) for m in (*measures, "claim_lines")])
