"""Names to classes: exact name first, then the genus."""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.functions.scalars import lookup


@dataclass(frozen=True)
class ClassMap:
    names: dict[str, int] = field(default_factory=dict)
    genera: dict[str, int] = field(default_factory=dict)

    def resolve(self, species: str | None) -> int | None:
        words = (species or "").lower().split(None, 1)
        tries = ((self.names, (species or "").lower().strip()), (self.genera, words[0])) if words else ()
        return next((table[key] for table, key in tries if key in table), None)

    def column(self, species: Column | str) -> Column:
        """The class of a species column; null where nothing matches."""
        key = F.trim(F.lower(F.col(species) if isinstance(species, str) else species))
        return F.coalesce(lookup(key, self.names), lookup(F.split(key, r"\s+")[0], self.genera)).cast("int")


def tidy(text: object) -> str:
    return str(text or "").lower().strip()


def claims(number: int, entry: dict) -> Iterator[tuple[str, str, int]]:
    """What an entry lays claim to: (names or genera, key, class)."""
    members = [tidy(m) for m in entry.get("members") or ()]
    own = [tidy(entry.get("name"))] if entry.get("source") else []  # a class that a survey names itself
    yield from (("names", key, number) for key in members + own if key)
    if entry.get("genus_fallback"):
        genus = tidy(entry.get("genus")) or next((m.split()[0] for m in members + own if m), "")
        if genus:
            yield "genera", genus, number


def build(maps: dict, name: str) -> ClassMap:
    """A ClassMap of a configuration's `class_maps`. Later claims win; oddities warn and never raise."""
    if name not in maps:
        raise KeyError(f"no class map {name!r}; there are {sorted(maps)}")
    entries = {str(k): v for k, v in (maps[name] or {}).items()}
    if not any(v.get("members") for v in entries.values() if isinstance(v, dict)):
        raise ValueError(f"class map {name!r} lists no members")
    usable = {k: v for k, v in entries.items() if isinstance(v, dict) and re.fullmatch(r"-?\d+", k)}
    for key in entries.keys() - usable.keys():
        warnings.warn(f"class map {name!r}: entry {key!r} is left out", stacklevel=2)
    tables: dict[str, dict[str, int]] = {"names": {}, "genera": {}}
    for table, key, number in (claim for k, v in usable.items() for claim in claims(int(k), v)):
        before = tables[table].get(key, number)
        if table == "names" and before != number:
            warnings.warn(f"class map {name!r}: {key!r} moves from {before} to {number}", stacklevel=2)
        tables[table][key] = number
    return ClassMap(**tables)


def with_class(df: DataFrame, classes: ClassMap, species: str = "species_normalized", out: str = "class_id") -> DataFrame:
    return df.withColumn(out, classes.column(species))


def with_class_joined(df: DataFrame, names: DataFrame, genera: DataFrame, species: str = "species_normalized", out: str = "class_id") -> DataFrame:
    """The same for crosswalks that are tables (key, class_id), as two left joins; Spark picks how."""
    keyed = df.withColumn("_name", F.trim(F.lower(species))).withColumn("_genus", F.split("_name", r"\s+")[0])
    keyed = keyed.join(names.select(F.col("key").alias("_name"), F.col("class_id").alias("_exact")), "_name", "left")
    keyed = keyed.join(genera.select(F.col("key").alias("_genus"), F.col("class_id").alias("_by_genus")), "_genus", "left")
    return keyed.withColumn(out, F.coalesce("_exact", "_by_genus")).drop("_name", "_genus", "_exact", "_by_genus")
