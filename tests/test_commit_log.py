"""Loads at the same time, in every order of their commits."""

import os
import threading

import pytest

from patchlens.plans import bulletin_warehouse as bw
from patchlens.sources import commit_log
from patchlens.sources.xml_bulletins import read_bulletins

AS_OF = "2024-04-20"


def document(title, kb, product):
    return (f'<cvrfdoc><DocumentTitle>{title}</DocumentTitle><ProductTree><FullProductName ProductID="{product}">Product {product}'
            f'</FullProductName></ProductTree><Vulnerability Ordinal="1"><Title>{title}</Title><CVE>CVE-{kb}</CVE>'
            f'<CVSSScoreSets><ScoreSet><BaseScore>7.5</BaseScore></ScoreSet></CVSSScoreSets>'
            f'<Remediations><Remediation Type="Vendor Fix"><Description>{kb}</Description><ProductID>1</ProductID>'
            f"<ProductID>2</ProductID></Remediation><Remediation Type=\"Other\"><Description>see notes</Description></Remediation>"
            f"</Remediations></Vulnerability></cvrfdoc>")


def landed(folder, label, title, kb, product, seconds):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{label}.xml"
    with open(path, "w") as f:
        f.write(document(title, kb, product))
    os.utime(path, (seconds, seconds))
    return path


def state(spark, root):
    msrc = bw.read_table(spark, root, "msrc_data").select("doc_xml_date", "kb", "kb_product_id", "product_names")
    titles = bw.read_table(spark, root, "document_info").select("id", "document_title")
    return sorted(map(tuple, msrc.collect())), sorted(map(tuple, titles.collect()))


def load(spark, path, root):
    return bw.load_documents(spark, read_bulletins(spark, path), root, AS_OF)


def test_numbers_are_given_once(spark, scratch):
    got, folder = [], f"{scratch}/ids"
    threads = [threading.Thread(target=lambda: got.extend(commit_log.reserve(spark, folder) for _ in range(5))) for _ in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == list(range(1, 31)) == commit_log.numbers(spark, folder)
    assert not commit_log.commit(spark, folder, 7, []) and commit_log.commit(spark, folder, 31, [{"a": 1}])


@pytest.mark.parametrize("months,second_is_newer", [(("2024-Jan", "2024-Feb"), True), (("2024-Jan", "2024-Jan"), True),
                                                    (("2024-Jan", "2024-Jan"), False)])
def test_two_loads_at_once(spark, scratch, monkeypatch, months, second_is_newer):
    """The second load runs from its start to its end just before the first one commits."""
    a = landed(f"{scratch}/a", months[0], "A", 100, 1, 2_000)
    b = landed(f"{scratch}/b", months[1], "B", 200, 2, 3_000 if second_is_newer else 1_000)
    root, real, seen = f"{scratch}/wh", commit_log.commit, []

    def between(spark_, folder, number, rows):
        if not seen:
            seen.append(number)
            load(spark, b, root)
        return real(spark_, folder, number, rows)

    monkeypatch.setattr(bw.commit_log, "commit", between)
    first = load(spark, a, root)
    monkeypatch.undo()
    one_by_one = f"{scratch}/plain"
    load(spark, b, one_by_one)  # the order of the commits
    load(spark, a, one_by_one)
    assert state(spark, root) == state(spark, one_by_one)
    loads = {(r.doc_xml_date, r.load_id) for r in bw.current_loads(spark, root).collect()}
    superseded = bw.rejects(spark, root).where("reason = 'superseded'").count()
    if months[0] != months[1]:
        # the catalog of the first names the product that only the second brought
        assert first == ["2024-Jan"] and loads == {("2024-Jan", 1), ("2024-Feb", 2)} and not superseded
        assert ("2024-Jan", "100", "2", "Product 2") in state(spark, root)[0]
    elif second_is_newer:
        assert first == [] and loads == {("2024-Jan", 2)} and superseded == 1
    else:
        assert first == ["2024-Jan"] and loads == {("2024-Jan", 1)} and not superseded


def test_a_failed_load_shows_nothing_and_its_number_is_not_used_again(spark, scratch, monkeypatch):
    a, root = landed(f"{scratch}/a", "2024-Jan", "A", 100, 1, 2_000), f"{scratch}/wh"
    with monkeypatch.context() as m:
        m.setattr(bw, "msrc_catalog", lambda *x: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load(spark, a, root)
    assert bw.current_loads(spark, root).count() == 0 and bw.read_table(spark, root, "vulnerability").count() == 0
    assert load(spark, a, root) == ["2024-Jan"]
    assert [r.load_id for r in bw.current_loads(spark, root).collect()] == [2]


def test_odd_rows_are_counted_as_they_are_written(spark, scratch):
    landed(f"{scratch}/in", "2024-Jan", "A", 100, 1, 2_000)
    landed(f"{scratch}/in", "2024-Feb", "B", 200, 1, 2_000)
    load(spark, f"{scratch}/in", f"{scratch}/wh")
    got = {r.reason: r.n for r in bw.quality(spark, f"{scratch}/wh").where("n > 0").collect()}
    assert got == {"score set without TemporalScore": 2, "score set without Vector": 2, "kb that is no number": 2,
                   "remediation without product": 2, "catalog row of an unknown product": 2}
    assert {r.load_id for r in bw.quality(spark, f"{scratch}/wh").collect()} == {1}
