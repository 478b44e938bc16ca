"""Tables of a relational database (S3) and the connection options for both ways."""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession

DRIVERS = {"postgresql": "org.postgresql.Driver", "postgres": "org.postgresql.Driver"}


def connection(dsn: str) -> tuple[str, dict[str, str]]:
    """JDBC address and properties of a ``scheme://user:password@host:port/db`` DSN."""
    parts = urlsplit(dsn)
    if parts.scheme not in DRIVERS:
        raise ValueError(f"unknown database scheme: {parts.scheme!r}")
    place = parts.hostname or "localhost"
    if parts.port:
        place = f"{place}:{parts.port}"
    properties = {"driver": DRIVERS[parts.scheme]}
    if parts.username:
        properties["user"] = unquote(parts.username)
    if parts.password:
        properties["password"] = unquote(parts.password)
    return f"jdbc:postgresql://{place}{parts.path}", properties


@dataclass(frozen=True)
class Split:
    """How to cut a table scan into parallel range queries on a number, date or timestamp."""

    column: str
    lower: int
    upper: int
    partitions: int


@dataclass(frozen=True)
class HashSplit:
    """How to cut a table scan into parallel queries on any column, text included."""

    column: str
    partitions: int

    def predicates(self) -> list[str]:
        """One condition per query; each row meets exactly one of them, null the first."""
        share = f"mod(abs(CAST(hashtext(CAST({self.column} AS text)) AS bigint)), {self.partitions})"
        first, *others = (f"{share} = {i}" for i in range(self.partitions))
        return [f"{first} OR {self.column} IS NULL", *others]


def read_database(
    spark: SparkSession, dsn: str, table: str, split: Split | HashSplit | None = None
) -> DataFrame:
    """S3: a table, by parallel queries when a split is given, else by one task."""
    url, properties = connection(dsn)
    if split is None:
        return spark.read.jdbc(url, table, properties=properties)
    if isinstance(split, HashSplit):
        return spark.read.jdbc(url, table, predicates=split.predicates(), properties=properties)
    return spark.read.jdbc(
        url,
        table,
        column=split.column,
        lowerBound=split.lower,
        upperBound=split.upper,
        numPartitions=split.partitions,
        properties=properties,
    )
