"""The two report definitions (municipal and corporate) as data."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class JsonField:
    """A scalar read from the JSON text of a composite row.

    ``kind`` is ``text``, ``float`` or a decimal type such as ``decimal(12,5)``.
    """

    column: str
    path: str
    kind: str


@dataclass(frozen=True)
class ReportConfig:
    name: str
    composites: str  # logical table of the composite snapshots
    id_column: str
    text_column: str  # JSON text of a composite row
    carries_text: bool  # keep the JSON text in the snapshot
    json_fields: tuple[JsonField, ...]
    price: str  # composite that ranks movers and drives sentiment
    dealers: str  # quote count shown as "Dealers"
    previous_must_be_positive: bool
    weights_table: str  # where the JSON with the quote weights is
    weights_id: str
    weights_text: str
    weights_root: str
    change_type: str | None  # cast of the price-only change
    seasoning: str  # date a security must have been issued by
    group: str
    total_label: str
    descriptive: tuple[str, ...]  # security columns shown in mover tables
    listed: tuple[str, ...]  # security columns shown in volume and quote tables
    min_dealers: int = 2
    quote_type: str = "PRICE"
    fold_quote_type: bool = False  # compare quote types without regard to case
    snap_hour: int = 15
    partition_column: str | None = None  # date column the snapshots are stored by


# Column names, JSON paths and labels of the published reports.
MUNI = ReportConfig(
    name="muni",
    composites="muni_composite",
    id_column="MuniCompositeId",
    text_column="JsonDetail",
    carries_text=True,
    json_fields=(
        JsonField("OriginalBidComposite", "OgBdCmp", "text"),
        JsonField("OriginalOfferComposite", "OgOfCmp", "text"),
        JsonField("BidOfferSpreadMessage", "BdOfSprMsg", "text"),
    ),
    price="OfferComposite",
    dealers="OfferCount",
    previous_must_be_positive=False,
    weights_table="muni_composite",
    weights_id="MuniCompositeId",
    weights_text="JsonDetail",
    weights_root="OfWts",
    change_type=None,
    seasoning="DatedDate",
    group="State",
    total_label="All States",
    descriptive=("Identifier", "SecurityName", "SecurityDescription", "ShortName"),
    listed=("Identifier", "SecurityName", "SecurityDescription", "ShortName"),
)

CORP = ReportConfig(
    name="corp",
    composites="corp_composite",
    id_column="CorpCompositeId",
    text_column="AdditionalData",
    carries_text=False,
    json_fields=(
        JsonField("ProviderCount", "Counts.All.PVR", "float"),
        JsonField("BidCount", "Counts.All.BID", "float"),
        JsonField("OfferCount", "Counts.All.OFR", "float"),
        JsonField("OriginalBidComposite", "OgBidCmp", "decimal(12,5)"),
        JsonField("OriginalOfferComposite", "OgOfrCmp", "decimal(12,5)"),
    ),
    price="BidComposite",
    dealers="BidCount",
    previous_must_be_positive=True,
    weights_table="corp_composite_debug",
    weights_id="CorpCompositeID",
    weights_text="DebugData",
    weights_root="BdWts",
    change_type="decimal(20,6)",
    seasoning="IssueDate",
    group="MoodysIndustry",
    total_label="All Industries",
    descriptive=("Identifier", "Ticker", "SecurityName"),
    listed=("Identifier", "SecurityName"),
)
