"""From blocks to everything that is known about them, in the order of an edition's life."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import text as T
from ledgerloom.functions import vocabulary as V
from ledgerloom.functions.storage import placed as checkpointed
from ledgerloom.operators import identity, mentions, observations, segmentation, views


@dataclass
class Edition:
    """Lazy tables of one set of blocks (doc_id, page, ord, block_id, text, role, noise); nothing runs until a table is used."""

    blocks: DataFrame

    def stored(self, matches: bool = True) -> Edition:
        """The same with its segmentation and the matches of all rules written to spark.checkpoint.dir, for uses that read them more than once.

        matches: false where only the segmentation is read more than once; each table then finds the matches of its own rules.
        """
        self.__dict__["assigned"] = checkpointed(self.assigned)
        if matches:
            self.__dict__["observed"] = checkpointed(observations.observed(self.assigned))
        if "text_original" not in self.blocks.columns:  # the stored rows are the blocks as well
            self.blocks = self.assigned.select("doc_id", "page", "ord", "block_id", "text", "role", "noise")
        return self

    def stored_fragments(self) -> Edition:
        """The same with its fragments written too, for uses that read those more than once."""
        self.__dict__["fragments"] = checkpointed(self.fragments)
        return self

    @cached_property
    def mentions(self) -> DataFrame:
        return mentions.mentions(self.blocks)

    @cached_property
    def assigned(self) -> DataFrame:
        return segmentation.assign(self.blocks)

    @cached_property
    def titled(self) -> DataFrame:
        """The segmentation with item_title in every block of an item."""
        return segmentation.assign(self.blocks, titled=True)

    def stored_members(self) -> Edition:
        """The same with the blocks of items, and nothing else, written to spark.checkpoint.dir."""
        self.__dict__["titled"] = checkpointed(self.titled.filter("item > 0").select("doc_id", "page", "n", "block_id", "text", "noise", "item", "item_title"))
        return self

    @cached_property
    def observed(self) -> DataFrame | None:
        """The stored matches of all rules; without them each table finds its own."""
        return None

    @cached_property
    def sections(self) -> DataFrame:
        return segmentation.sections(self.assigned)

    @cached_property
    def contexts(self) -> DataFrame:
        return segmentation.contexts(self.assigned)

    @cached_property
    def items(self) -> DataFrame:
        return segmentation.items(self.assigned)

    @cached_property
    def references(self) -> DataFrame:
        return observations.references(self.assigned, self.observed)

    @cached_property
    def provisions(self) -> DataFrame:
        return observations.provisions(self.assigned, self.observed)

    @cached_property
    def actions(self) -> DataFrame:
        return observations.actions(self.assigned, self.observed)

    @cached_property
    def entities(self) -> DataFrame:
        return observations.entities(self.assigned, self.observed)

    @cached_property
    def fragments(self) -> DataFrame:
        return identity.fragments(self.entities, self.mentions, observations.references(self.assigned, self.observed, ("cnpj",)))

    @cached_property
    def identified(self) -> DataFrame:
        """Fragments that hold an identifier, of one pass over the segmentation."""
        return identity.identified(self.assigned)

    @cached_property
    def process_items(self) -> DataFrame:
        return views.process_items(self.titled)


def summary(blocks: DataFrame) -> DataFrame:
    """doc_id, pages, blocks, noise_blocks, mentions, distinct_values, orphans."""
    base = blocks.groupBy("doc_id").agg(F.count_distinct("page").alias("pages"), F.count("*").alias("blocks"), F.count_if("noise").alias("noise_blocks"))
    found = mentions.mentions(blocks)
    counts = found.groupBy("doc_id").agg(F.count("*").alias("mentions"), F.count_distinct("value_normalized").alias("distinct_values"))
    lost = mentions.orphans(found, blocks).groupBy("doc_id").agg(F.count("*").alias("orphans"))
    return base.join(counts, "doc_id", "left").join(lost, "doc_id", "left").na.fill(0)


def dry_run(manifest: DataFrame, blocks: DataFrame, mentions_: DataFrame) -> DataFrame:
    """One report row per document of manifest (doc_id, filename, sha256): document_key, document_sha256, pages, blocks, mentions, missing_blocks."""
    base = blocks.groupBy("doc_id").agg(F.count_distinct("page").alias("pages"), F.count("*").alias("blocks"))
    there = blocks.select("doc_id", "block_id", F.lit(True).alias("there"))
    found = mentions_.select("doc_id", "block_id").join(there, ["doc_id", "block_id"], "left")
    found = found.groupBy("doc_id").agg(F.count("*").alias("mentions"), F.count_distinct(F.when(F.col("there").isNull(), F.col("block_id"))).alias("missing_blocks"))
    rows = manifest.select("doc_id", T.edition_key(F.col("filename"))["document_key"].alias("document_key"), F.col("sha256").alias("document_sha256"))
    return rows.join(base, "doc_id").join(found, "doc_id", "left").na.fill(0, ["mentions", "missing_blocks"])


def against_baseline(found: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """keys, name, actual, expected of counters that differ; null equals null."""
    names = [c for c in found.columns if c not in keys]
    rows = found.unpivot(keys, names, "name", "actual").join(expected.unpivot(keys, names, "name", "expected"), [*keys, "name"], "full")
    return rows.filter(~F.col("actual").eqNullSafe(F.col("expected")))


CATEGORIES = V.CATEGORIES
