"""Elements of texts at any depth against the standard library's tree."""

import random
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from patchlens.plans import bulletin_warehouse as bw
from patchlens.plans import element_walk as ew
from patchlens.sources.xml_bulletins import parse_bulletin_text, read_bulletins

DEEP = """<?xml version="1.0"?><!-- <Vulnerability Ordinal="0"> -->
<cvrf:cvrfdoc xmlns:cvrf="http://c" xmlns:vuln="http://v">
<vuln:Vulnerability Ordinal="1"><vuln:Meta><vuln:Inner note="a > b"><vuln:Title> 1.10 &amp; &#xe9;&#233; </vuln:Title></vuln:Inner></vuln:Meta>
<vuln:Title>second</vuln:Title><vuln:Empty/><vuln:CVE><![CDATA[<C&amp;1>]]></vuln:CVE></vuln:Vulnerability>
<Vulnerability Ordinal='02'><Threats><Threat><More><Description>deep &lt;x&gt;</Description></More></Threat>
<Threat><Description>shallow</Description></Threat></Threats></Vulnerability>
<Vulnerability Ordinal="3"/>
</cvrf:cvrfdoc>"""


def walked(spark, *texts):
    return ew.elements(spark.createDataFrame(list(enumerate(texts)), "k int, x string"), ["k"], "x")


def test_find_is_the_first_descendant_at_any_depth(spark):
    w = walked(spark, DEEP)
    titles = [(r.text, r.start) for r in ew.find(w, ["k"], "Vulnerability", "Title").collect()]
    assert [t for t, _ in titles] == ["1.10 & éé"]  # two levels deeper than the second title, and text as it stands
    found = ew.find_all(w, ["k"], "Vulnerability", "Title").orderBy("found").collect()
    assert [r.text for r in found] == ["1.10 & éé", "second"]
    described = ew.find_all(w, ["k"], "Vulnerability", "Description").orderBy("found").collect()
    assert [r.text for r in described] == ["deep <x>", "shallow"]
    assert [r.text for r in ew.find(w, ["k"], "Threat", "Description").orderBy("start").collect()] == ["deep <x>", "shallow"]
    assert ew.find(w, ["k"], "Vulnerability", "CVE").first().text == "<C&amp;1>"
    ordinals = w.where("name = 'Vulnerability'").orderBy("start").select(ew.attribute("Ordinal")).collect()
    assert [r[0] for r in ordinals] == ["1", "02", "3"]
    assert w.where("name = 'Inner'").select(ew.attribute("note")).first()[0] == "a > b"


def random_tree(rng, depth):
    node = ET.Element(rng.choice("abc"), {"i": str(rng.randint(0, 9))} if rng.random() < 0.5 else {})
    node.text = rng.choice(["", " t ", "x<y", "01"])
    for _ in range(rng.randint(0, 3) if depth else 0):
        child = random_tree(rng, depth - 1)
        child.tail = rng.choice(["", "tail"])
        node.append(child)
    return node


@pytest.mark.parametrize("seed", range(2))
def test_random_trees(spark, seed):
    rng = random.Random(seed)
    trees = [random_tree(rng, 6) for _ in range(25)]
    w = walked(spark, *(ET.tostring(t, encoding="unicode") for t in trees))
    got = {}
    for r in w.orderBy("k", "start").collect():
        got.setdefault(r.k, []).append(r)
    for k, tree in enumerate(trees):
        rows = got[k]
        place = {r.start: n for n, r in enumerate(rows)}
        nodes = list(tree.iter())
        up = {c: p for p in nodes for c in p}
        assert [r.name for r in rows] == [n.tag for n in nodes]
        assert [{a.name: a.value for a in r.attributes} for r in rows] == [n.attrib for n in nodes]
        assert [r.text for r in rows] == ["".join([n.text or "", *(c.tail or "" for c in n)]).strip() for n in nodes]
        assert [None if r.parent is None else place[r.parent] for r in rows] == [
            nodes.index(up[n]) if n in up else None for n in nodes]


def nested(depth, label):
    branch = "".join(f'<prod:Branch Type="T{i}" Name="N{i}">' for i in range(depth))
    return (f'<cvrfdoc xmlns:prod="p"><DocumentTitle>{label}</DocumentTitle><prod:ProductTree>'
            f'<prod:FullProductName ProductID="0">Top</prod:FullProductName>{branch}'
            f'<prod:FullProductName ProductID="007">Part 1.10</prod:FullProductName>{"</prod:Branch>" * depth}'
            f'<prod:Relationship><prod:FullProductName ProductID="r">no</prod:FullProductName></prod:Relationship>'
            f"</prod:ProductTree></cvrfdoc>")


def test_deep_trees_of_texts_and_files_alike(spark, scratch):
    depths = {"2024-Jan": 3, "2024-Feb": 9, "2024-Mar": 30}
    texts = {label: nested(d, label) for label, d in depths.items()}
    want = sorted([("0", "Top", "", "", m) for m in depths]
                  + [("007", "Part 1.10", f"T{d - 1}", f"N{d - 1}", m) for m, d in depths.items()])
    held = parse_bulletin_text(spark.createDataFrame(list(texts.items()), "m string, x string"), "x", "m")
    assert sorted(map(tuple, bw.deep_products(spark, held).collect())) == want
    for label, text in texts.items():
        with open(f"{scratch}/{label}.xml", "w") as f:
            f.write(text)
    assert sorted(map(tuple, bw.deep_products(spark, read_bulletins(spark, scratch)).collect())) == want
    bw.load_documents(spark, held, f"{scratch}/wh", "2024-04-20")
    stored = bw.read_table(spark, f"{scratch}/wh", "product")
    assert sorted(map(tuple, stored.collect())) == want


def test_odd_texts(spark):
    w = walked(spark, "", None, "no tags", "<a><b></a>", "<a/>")
    # an element without an end takes no part: the closing tag ends the one before it
    assert sorted((r.k, r.name) for r in w.collect()) == [(3, "b"), (4, "a")]
    one = spark.createDataFrame([("&#65;&#x1F642;&amp;lt; &unknown;",)], "x string")
    assert one.select(ew.unescaped(F.col("x"))).first()[0] == "A🙂&lt; &unknown;"


def test_elements_of_many_texts_are_not_broadcast(spark):
    """Sizes are those of the texts, far below those of their elements: no join may rest on them."""
    texts = spark.range(3).selectExpr("cast(id AS string) AS doc", "'<a><b>x</b></a>' AS xml")
    for walked in (ew.elements(texts, ["doc"], "xml"), ew.walked_products(texts, "doc", "xml")):
        plan = walked._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
