"""Rules over collections of sources and files."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relievo.operators.filters import in_box
from relievo.operators.joins import unprocessed


def source_weights(registry: DataFrame, hooks: Mapping[str, Callable[[Column], Column]], name: str = "dset_name", score: str = "ranking_score") -> DataFrame:
    """Active sources with their weights; a source class may put a hook from its score to its weight."""
    rank = F.col(score).cast("double")
    weight = rank
    for source, hook in hooks.items():
        weight = F.when(F.col(name) == source, hook(rank)).otherwise(weight)
    return registry.where("is_active").withColumn("weight", weight)


def active_variants(registry: DataFrame, bed: bool, surface_only: Column, bed_only: Column) -> DataFrame:
    """Active sources without those of the other mode: a source may serve surfaces only or beds only."""
    return registry.where("is_active").where(~F.coalesce(surface_only if bed else bed_only, F.lit(False)))


def map_missing(tasks: DataFrame, done: DataFrame, keys: Sequence[str], work: Callable[[pd.DataFrame], pd.DataFrame], schema: str, overwrite: bool = False) -> DataFrame:
    """A function over a table of argument lists, batch by batch, without those whose output is there."""
    todo = tasks if overwrite else unprocessed(tasks, done, keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from map(work, batches)

    return todo.mapInPandas(run, schema)


def in_converted_box(rows: DataFrame, x: str, y: str, box: Sequence[float], convert: Callable[[Column, Column], tuple[Column, Column]], edges: str = "left") -> DataFrame:
    """Rows whose converted coordinates lie in a box; the conversion is a function of columns."""
    px, py = convert(F.col(x), F.col(y))
    return in_box(rows.withColumns({"__x": px, "__y": py}), "__x", "__y", box, edges).drop("__x", "__y")


def data_links(entries: DataFrame, order: str, links: str = "links", by: Sequence[str] = ()) -> DataFrame:
    """The data links of catalogue entries: ``(*by, order, place, href)``, all that pass, each file once.

    A link is a struct of href and, if known, rel, inherited and title. It goes if it has no
    href, is inherited, has a relation without ``data#`` in it or a title that names
    OPeNDAP; what a link does not say does not exclude it. Of links to one file name within
    a search result (``by``), the first stays, by the entry's ``order`` and the link's place.
    """
    rows = entries.select(*by, order, F.posexplode(links).alias("place", "l"))
    said = {f.name for f in rows.schema["l"].dataType.fields}
    keep = F.col("l.href").isNotNull()
    if "inherited" in said:
        keep &= ~F.coalesce("l.inherited", F.lit(False))
    if "rel" in said:
        keep &= F.coalesce(F.col("l.rel").contains("data#"), F.lit(True))
    if "title" in said:
        keep &= ~F.coalesce(F.lower("l.title").contains("opendap"), F.lit(False))
    at = F.struct(order, "place")
    named = rows.where(keep).groupBy(*by, F.substring_index("l.href", "/", -1).alias("__file")).agg(F.min(at).alias("at"), F.min_by("l.href", at).alias("href"))
    return named.select(*by, f"at.{order}", "at.place", "href")


def entry_lists(tiles: DataFrame, sources: DataFrame, registry: DataFrame, size: float, hooks: Mapping[str, Callable[[DataFrame], DataFrame]], excluded: Column | None = None) -> DataFrame:
    """J8's entries, where a source class may make its own.

    A hook, by the name of its source, gets the class's entries ``(tile_id, filename, weight, dset_name)``
    over all target tiles and returns what stands in their place, with the same
    columns: other weights, fewer files or more. Sources without a hook keep J8's.
    """
    from relievo.operators.joins import datalist

    entries = datalist(tiles, sources, registry, size, excluded).withColumn("weight", F.col("weight").cast("double"))
    own = F.col("dset_name").isin(list(hooks)) if hooks else F.lit(False)
    out = entries.where(~own)
    for name, hook in hooks.items():
        out = out.unionByName(hook(entries.where(F.col("dset_name") == name)).select(out.columns))
    return out
