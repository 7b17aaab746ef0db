"""Parameters of one report run."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date


@dataclass(frozen=True)
class ReportSettings:
    """What a run needs to know besides its tables.

    ``paid_thru``        month end up to which payments are complete
    ``credible_start``   first month end-to-end present in the claims
    ``history_cutoff``   no window may start before this day
    ``runout_months``    months left out so that late payments can arrive
    ``component_label``  ``risk_score_type`` of members scored with component scores
    ``has_rx``           whether a pharmacy claim table is supplied
    """

    client: str = "Sample Client"
    paid_thru: date = date(2001, 10, 31)
    credible_start: date = date(1999, 1, 1)
    history_cutoff: date = date(1999, 1, 1)
    runout_months: int = 2
    lob: str = "MEDICARE"
    hcc_label: str = "CMS HCC Risk Score"
    component_label: str = "Component Risk Score"
    has_rx: bool = True
    claims_basis: str = "discharge"
    project: dict = field(default_factory=dict)
