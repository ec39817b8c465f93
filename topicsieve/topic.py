"""The one editable topic a corpus is scored against."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TOPIC_SCHEMA = (
    "topic_name string, query_text string, axes map<string, array<string>>, "
    "weights map<string, double>, year_range array<int>, thresholds map<string, double>, "
    "query_vector array<double>, updated_at timestamp"
)


@dataclass(frozen=True)
class Topic:
    """Driver-side topic; its parts become literals of the scoring expressions."""

    topic_name: str
    query_text: str
    axes: dict[str, list[str]]
    year_range: tuple[int, int]
    weights: dict[str, float] = field(default_factory=dict)
    thresholds: dict[str, float] | None = None
    query_vector: tuple[float, ...] | None = None
    updated_at: datetime | None = None

    def __post_init__(self) -> None:
        if len(self.year_range) != 2:
            raise ValueError("year_range needs exactly two years")

    def patched(self, embed=None, **fields) -> "Topic":
        """Replace the given non-null fields.

        The query vector is recomputed with ``embed`` whenever ``query_text`` is
        among them.
        """
        given = {name: value for name, value in fields.items() if value is not None}
        if not given:
            raise ValueError("nothing to update")
        if "query_text" in given and embed is not None:
            given["query_vector"] = tuple(embed(given["query_text"]))
        return replace(self, updated_at=datetime.now(timezone.utc), **given)

    def frame(self, spark: SparkSession) -> DataFrame:
        row = asdict(self)
        row["year_range"] = list(self.year_range)
        row["query_vector"] = list(self.query_vector) if self.query_vector is not None else None
        names = StructType.fromDDL(TOPIC_SCHEMA).names
        return spark.createDataFrame([tuple(row[name] for name in names)], TOPIC_SCHEMA)

    @classmethod
    def from_frame(cls, df: DataFrame) -> "Topic":
        row = df.limit(1).collect()[0].asDict()
        row["year_range"] = tuple(row["year_range"])
        row["query_vector"] = tuple(row["query_vector"]) if row["query_vector"] is not None else None
        row["weights"] = row["weights"] or {}
        return cls(**row)
