"""Elements of XML texts at any depth, as rows with nested intervals.

A text is cut into tags and texts once; a running sum of opened and closed tags gives every
element its depth, and the tag that closes it is the next one of that depth.  So an
element is an interval of token numbers, what lies inside it is what begins inside the
interval, and a first-descendant lookup (``find``) is the smallest beginning there, however
deep: no schema, no number of levels, no second parse.  Text stays text (a parse to
VARIANT types it: ``1.10`` becomes 1.1 and ``01`` becomes 1).

Namespace prefixes are ignored; comments and processing instructions are skipped; CDATA is
text as it stands.  An element without an end takes no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patchlens import schemas

TOKEN = (r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^<]++")
ATTRIBUTE = r"(?s)([\w:.-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)')"
#: fixed values: the predefined entities
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&amp;": "&"}


def unescaped(text: Column) -> Column:
    """Character references and predefined entities as their characters."""
    def code(ref: Column) -> Column:
        number = F.regexp_extract(ref, r"([0-9A-Fa-f]+);", 1)
        hexed = F.when(F.lower(F.substring(ref, 3, 1)) == "x", number).otherwise(F.conv(number, 10, 16))
        return F.decode(F.unhex(F.lpad(hexed, 8, "0")), "UTF-32")

    out = F.aggregate(F.array_distinct(F.regexp_extract_all(text, F.lit(r"&#x?[0-9A-Fa-f]+;"), F.lit(0))), text,
                      lambda acc, ref: F.replace(acc, ref, code(ref)))
    for entity, char in ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def attribute(name: str) -> Column:
    """The value of an element's attribute, NULL when it has none."""
    return F.get(F.filter("attributes", lambda a: a["name"] == name), F.lit(0))["value"]


def _attributes(tag: Column) -> Column:
    found = F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(0))
    return F.transform(found, lambda a: F.struct(
        F.regexp_replace(F.regexp_extract(a, ATTRIBUTE, 1), "^.*:", "").alias("name"),
        unescaped(F.concat(F.regexp_extract(a, ATTRIBUTE, 2), F.regexp_extract(a, ATTRIBUTE, 3))).alias("value")))


def elements(texts: DataFrame, keys: list[str], xml: str) -> DataFrame:
    """(*keys, start, stop, depth, name, attributes, parent, text): every element of every text; ``parent`` is where
    its parent starts (NULL at the top), ``text`` what stands directly in it, without the space around."""
    tokens = texts.select(*keys, F.posexplode(F.regexp_extract_all(xml, F.lit(TOKEN), F.lit(0))).alias("start", "_t"))
    data = F.col("_t").startswith("<![CDATA[")
    kind = (F.when(data | ~F.col("_t").startswith("<"), "text")
            .when(F.col("_t").startswith("<!") | F.col("_t").startswith("<?"), "none")
            .when(F.col("_t").startswith("</"), "close").when(F.col("_t").endswith("/>"), "single").otherwise("open"))
    tokens = tokens.withColumn("_kind", kind).where("_kind <> 'none'")
    document = Window.partitionBy(*keys).orderBy("start")
    level = F.sum(F.when(F.col("_kind") == "open", 1).when(F.col("_kind") == "close", -1).otherwise(0)).over(document)
    tokens = tokens.withColumn("depth", level + F.col("_kind").isin("close", "single").cast("int"))
    same_depth = Window.partitionBy(*keys, "depth").orderBy("start")
    tags = tokens.where("_kind IN ('open', 'close', 'single')").withColumn("stop", F.when(
        F.col("_kind") == "single", F.col("start")).otherwise(F.lead("start").over(same_depth)))
    opened = tags.where("_kind <> 'close' AND stop IS NOT NULL").select(
        *keys, "start", "stop", "depth", F.regexp_extract("_t", r"^<(?:[\w.-]+:)?([\w.-]+)", 1).alias("name"),
        _attributes(F.col("_t")).alias("attributes"))

    # what stands directly in an element, and its children, follow its start at one depth of the document
    own = opened.select(*keys, F.col("depth").alias("_in"), "start", F.col("start").alias("_own"))
    children = opened.select(*keys, (F.col("depth") - 1).alias("_in"), "start", F.lit(None).cast("int").alias("_own"))
    above = Window.partitionBy(*keys, "_in").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    parents = (own.unionByName(children).withColumn("parent", F.last("_own", ignorenulls=True).over(above))
               .where("_own IS NULL").select(*keys, "start", "parent"))
    clean = F.when(data, F.regexp_extract("_t", r"(?s)^<!\[CDATA\[(.*)\]\]>$", 1)).otherwise(unescaped(F.col("_t")))
    strings = tokens.where("_kind = 'text'").select(*keys, F.col("depth").alias("_in"), "start", clean.alias("_s"))
    inside = (own.withColumn("_s", F.lit(None).cast("string")).unionByName(strings, allowMissingColumns=True)
              .withColumn("_of", F.last("_own", ignorenulls=True).over(above)).where("_own IS NULL AND _of IS NOT NULL")
              .groupBy(*keys, F.col("_of").alias("start"))
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "_s"))), lambda x: x["_s"]), "")
                   .alias("text")))
    on = [*keys, "start"]
    # a size check sees the texts, not the elements they are cut into, and would send all of these to the driver
    return (opened.join(parents.hint("shuffle_merge"), on, "left").join(inside.hint("shuffle_merge"), on, "left")
            .withColumn("text", F.trim(F.coalesce("text", F.lit("")), F.lit(" \t\r\n"))))


def find_all(walked: DataFrame, keys: list[str], of: str, name: str) -> DataFrame:
    """(*keys, start, found, text, attributes): the descendants called ``name`` of every ``of`` (elements that do not
    hold each other), in document order of ``found``; an ``of`` without any has no row."""
    both = walked.where(F.col("name").isin(of, name))
    holder = F.last(F.when(F.col("name") == of, F.struct("start", "stop")), ignorenulls=True).over(
        Window.partitionBy(*keys).orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    return (both.withColumn("_of", holder).where((F.col("name") == name) & (F.col("start") < F.col("_of.stop")))
            .select(*keys, F.col("_of.start").alias("start"), F.col("start").alias("found"), "text", "attributes"))


def find(walked: DataFrame, keys: list[str], of: str, name: str) -> DataFrame:
    """The first of :func:`find_all` of every ``of``."""
    first = F.min_by(F.struct("found", "text", "attributes"), "found").alias("_first")
    return find_all(walked, keys, of, name).groupBy(*keys, "start").agg(first).select(*keys, "start", "_first.*")


def walked_products(texts: DataFrame, label: str, xml: str) -> DataFrame:
    """The rows of :func:`patchlens.plans.shred.product` for documents as texts, whatever the depth of their trees."""
    walked = elements(texts, [label], xml)
    branch = walked.select(label, F.col("start").alias("parent"), F.col("name").alias("_above"),
                           attribute("Type").alias("_type"), attribute("Name").alias("_name"))
    named = walked.where(F.col("name") == "FullProductName").join(branch.hint("shuffle_merge"), [label, "parent"]).where(
        F.col("_above").isin("Branch", "ProductTree"))

    def of_branch(c: str) -> Column:
        return F.coalesce(F.when(F.col("_above") == "Branch", F.col(c)), F.lit(""))

    return named.select(F.coalesce(attribute("ProductID"), F.lit("")).alias("id"), F.col("text").alias("product_name"),
                        of_branch("_type").alias("product_type"), of_branch("_name").alias("branch_name"),
                        F.col(label).alias("doc_xml_date")).select(*schemas.STAGING["product"].fieldNames())
