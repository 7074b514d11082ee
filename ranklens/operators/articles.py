"""Nested articles as relational operators.

Articles arrive as an adjacency table ``nodes(page_id, node_id, parent_id,
ord, kind, heading, heading_id, para_id)`` (a StructType cannot be recursive)
and paragraphs as ``(para_id, bodies array<struct<...>>)``.  Heading paths
are built by iterated parent joins, one join per outline level (outlines are
shallow; the loop stops when a level adds no section).  Every step is a
distributed join; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklens.session import checkpoint_dir


def section_paths(nodes: DataFrame) -> DataFrame:
    """(page_id, node_id, path_ids array, headings array, depth) for every section."""
    sec = nodes.where(F.col("kind") == "section").select("page_id", "node_id", "parent_id", "heading", "heading_id", "ord")
    cur = sec.where(F.col("parent_id").isNull()).select(
        "page_id", "node_id", F.array("heading_id").alias("path_ids"), F.array("heading").alias("headings"),
        F.array("ord").alias("ords"), F.lit(1).alias("depth"),
    )
    checkpoint_dir(nodes.sparkSession)
    out = cur = cur.checkpoint()
    depth, total = 1, sec.count()
    while True:
        nxt = sec.alias("s").join(cur.alias("c"), (F.col("s.parent_id") == F.col("c.node_id")) & (F.col("s.page_id") == F.col("c.page_id"))).select(
            F.col("s.page_id").alias("page_id"),
            F.col("s.node_id").alias("node_id"),
            F.concat(F.col("c.path_ids"), F.array(F.col("s.heading_id"))).alias("path_ids"),
            F.concat(F.col("c.headings"), F.array(F.col("s.heading"))).alias("headings"),
            F.concat(F.col("c.ords"), F.array(F.col("s.ord"))).alias("ords"),
            (F.col("c.depth") + 1).alias("depth"),
        )
        nxt = nxt.checkpoint()  # each level's join runs once
        if nxt.isEmpty():
            break
        depth += 1
        if depth > total:
            raise ValueError("sections form a cycle")
        out = out.unionByName(nxt)
        cur = nxt
    return out


def section_path_id(page_id, path_ids) -> F.Column:
    """``pageId/heading1/heading2``."""
    return F.concat_ws("/", F.concat(F.array(page_id), path_ids))


def _with_path_id(paths: DataFrame) -> DataFrame:
    return paths.withColumn("section_path_id", section_path_id(F.col("page_id"), F.col("path_ids")))


def leaf_section_paths(nodes: DataFrame) -> DataFrame:
    """Root-to-leaf heading paths (sections without section children)."""
    p = _with_path_id(section_paths(nodes))
    has_child = nodes.where((F.col("kind") == "section") & F.col("parent_id").isNotNull()).select(F.col("parent_id").alias("node_id"), "page_id")
    leaves = p.join(has_child.distinct(), ["page_id", "node_id"], "left_anti")
    return leaves.select("page_id", "section_path_id", "headings")


def section_paragraphs(nodes: DataFrame) -> DataFrame:
    """(page_id, section_path_id, headings, para_id, ord) for paragraphs at any depth, page level included."""
    p = _with_path_id(section_paths(nodes)).select("page_id", F.col("node_id").alias("parent_id"), "section_path_id", "headings")
    para = nodes.where(F.col("kind") == "para").select("page_id", "parent_id", "para_id", "ord")
    in_sec = para.join(p, ["page_id", "parent_id"])
    top = para.where(F.col("parent_id").isNull()).select(
        "page_id", "parent_id", "para_id", "ord", F.col("page_id").alias("section_path_id"), F.array().cast("array<string>").alias("headings")
    )
    return in_sec.unionByName(top).select("page_id", "section_path_id", "headings", "para_id", "ord")


def child_sections(nodes: DataFrame) -> DataFrame:
    """Direct child sections of every section: (page_id, parent_path_id, child_heading, ord)."""
    p = _with_path_id(section_paths(nodes)).select("page_id", F.col("node_id").alias("parent_id"), F.col("section_path_id").alias("parent_path_id"))
    ch = nodes.where((F.col("kind") == "section") & F.col("parent_id").isNotNull()).select("page_id", "parent_id", F.col("heading").alias("child_heading"), "ord")
    return ch.join(p, ["page_id", "parent_id"]).select("page_id", "parent_path_id", "child_heading", "ord")


def paragraph_text(paragraphs: DataFrame) -> DataFrame:
    """Text and link anchors concatenated in order."""
    t = F.array_join(
        F.transform("bodies", lambda b: F.when(b["kind"] == "text", b["text"]).otherwise(b["anchor"])), ""
    )
    return paragraphs.select("para_id", t.alias("text"))


def paragraph_entities(paragraphs: DataFrame) -> DataFrame:
    """Linked page names in order."""
    e = F.transform(F.filter("bodies", lambda b: b["kind"] == "link"), lambda b: b["page"])
    return paragraphs.select("para_id", e.alias("entities"))


def link_sections(paragraphs: DataFrame) -> DataFrame:
    """Every link with its optional target section: (para_id, turn, page, page_id, link_section, anchor)."""
    links = paragraphs.select("para_id", F.explode(F.filter("bodies", lambda b: b["kind"] == "link")).alias("b"))
    return links.select("para_id", "b.turn", "b.page", "b.page_id", "b.link_section", "b.anchor")


def dedupe_paragraph(paragraphs: DataFrame) -> DataFrame:
    """Paragraphs are equal iff their ids are equal."""
    return paragraphs.dropDuplicates(["para_id"])


def article_plain_text(nodes: DataFrame, pages: DataFrame, paragraphs: DataFrame, min_len: int = 10) -> DataFrame:
    """One line per paragraph: page title, heading path and text, for texts longer than ``min_len``."""
    sp = section_paragraphs(nodes).join(pages, "page_id").join(paragraph_text(paragraphs), "para_id")
    line = F.concat_ws(" ", F.concat(F.array("page_name"), "headings", F.array("text")))
    return sp.where(F.length("text") > min_len).select("page_id", "para_id", line.alias("line"))
