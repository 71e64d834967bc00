"""Silver projections of the two reference APIs and ingest configuration.

The field lists are fixed values: JSON path, Silver type, Silver column, in
the order of the reference's Silver SQL. One spec per API (the Met spec has
all 32 columns, including the artist begin/end dates).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from strata.operators.silver import Field, spec
from strata.sources.ids import check_cap

# Met object detail -> Silver (path, type, column).
MET_OBJECTS = spec(
    ("objectID", "bigint", "met_object_id"),
    ("accessionNumber", "string", "accession_number"),
    ("accessionYear", "string", "accession_year"),
    ("isHighlight", "boolean", "is_highlight"),
    ("isPublicDomain", "boolean", "is_public_domain"),
    ("title", "string", "title"),
    ("objectDate", "string", "object_date"),
    ("objectBeginDate", "int", "object_begin_date"),
    ("objectEndDate", "int", "object_end_date"),
    ("medium", "string", "medium"),
    ("dimensions", "string", "dimensions"),
    ("classification", "string", "classification"),
    ("department", "string", "department"),
    ("culture", "string", "culture"),
    ("period", "string", "period"),
    ("dynasty", "string", "dynasty"),
    ("reign", "string", "reign"),
    ("artistDisplayName", "string", "artist_display_name"),
    ("artistDisplayBio", "string", "artist_display_bio"),
    ("artistRole", "string", "artist_role"),
    ("artistNationality", "string", "artist_nationality"),
    ("artistBeginDate", "string", "artist_begin_date"),
    ("artistEndDate", "string", "artist_end_date"),
    ("primaryImage", "string", "primary_image_url"),
    ("primaryImageSmall", "string", "primary_image_small_url"),
    ("objectURL", "string", "object_url"),
    ("tags", "json", "tags_raw_json"),
    ("measurements", "json", "measurements_raw_json"),
    ("additionalImages", "json", "additional_images_raw_json"),
    ("constituents", "json", "constituents_raw_json"),
)

# Stripe customer -> Silver (path, type, column).
STRIPE_CUSTOMERS = spec(
    ("email", "string", "email"),
    ("name", "string", "name"),
    ("created", "bigint", "created_at_unix"),
    ("description", "string", "description"),
    ("phone", "string", "phone"),
    ("currency", "string", "currency"),
    ("delinquent", "boolean", "delinquent"),
    ("livemode", "boolean", "livemode"),
    ("address", "json", "address_raw_json"),
    ("metadata", "json", "metadata_raw_json"),
)



@dataclass
class IngestConfig:
    """One API ingest: where to list and fetch, how fast, where to land.

    ``max_objects``: None = all, 0 = none, negative = error (one rule for
    every cap). ``min_success_ratio`` gates the swap of Bronze: a run whose
    fetched rows are mostly errors leaves the previous table in place.
    """
    name: str
    detail_url: str
    list_url: str | None = None
    rate_per_sec: float | None = None
    partitions: int = 8
    key_type: str = "bigint"
    max_objects: int | None = None
    table: str = ""
    runs_table: str | None = None
    min_success_ratio: float | None = None
    headers: dict = field(default_factory=dict)

    def __post_init__(self):
        self.max_objects = check_cap(self.max_objects)
        if self.key_type not in ("bigint", "string"):
            raise ValueError("key_type must be 'bigint' or 'string'")
        if len(self.table.split(".")) not in (1, 2, 3):
            raise ValueError(f"bad table name {self.table!r}")

    @classmethod
    def from_params(cls, defaults: dict, params: dict) -> "IngestConfig":
        """Job parameters override defaults; blank strings count as unset."""
        merged = dict(defaults)
        for k, v in (params or {}).items():
            if v is None or (isinstance(v, str) and not v.strip()):
                continue
            merged[k] = v
        for k in ("max_objects", "partitions"):
            if isinstance(merged.get(k), str):
                merged[k] = int(merged[k])
        for k in ("rate_per_sec", "min_success_ratio"):
            if isinstance(merged.get(k), str):
                merged[k] = float(merged[k])
        return cls(**merged)
