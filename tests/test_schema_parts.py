"""Documents parsed for some tables only: values are built for the parts that these tables are made from."""
from patchlens import schemas
from patchlens.plans import shred
from patchlens.queries_xml import QUERIES
from patchlens.sources.xml_bulletins import parse_bulletin_text

XML = ('<c:cvrfdoc xmlns:c="c"><DocumentTitle>t</DocumentTitle><v:Vulnerability xmlns:v="v" Ordinal="1"><v:Title>a &amp; b</v:Title>'
       '<v:Title>again</v:Title><v:CVE>CVE-1</v:CVE><v:CWE ID="7">seven</v:CWE><v:Notes><v:Note Title="n" Type="k" Ordinal="1">x</v:Note>'
       '</v:Notes><v:ProductStatuses><v:Status Type="Known"><v:ProductID>1</v:ProductID><v:ProductID>2</v:ProductID></v:Status>'
       '</v:ProductStatuses><v:Threats><v:Threat Type="Impact"><v:Description>d</v:Description></v:Threat></v:Threats>'
       '<v:CVSSScoreSets><v:ScoreSet><v:BaseScore>7.0</v:BaseScore><v:ProductID>1</v:ProductID></v:ScoreSet></v:CVSSScoreSets>'
       '<v:Acknowledgments><v:Acknowledgment><v:Name>w</v:Name><v:URL/></v:Acknowledgment></v:Acknowledgments><v:RevisionHistory>'
       '<v:Revision><v:Number>1.0</v:Number><v:Date>2024-01-01</v:Date></v:Revision></v:RevisionHistory><v:Remediations>'
       '<v:Remediation Type="Vendor Fix"><v:Description>42</v:Description><v:URL>u</v:URL></v:Remediation></v:Remediations>'
       '</v:Vulnerability><v:Vulnerability xmlns:v="v"><v:Title>bare</v:Title></v:Vulnerability></c:cvrfdoc>')
ODD = ["<cvrfdoc/>", "<cvrfdoc>open", "", None, '<cvrfdoc><Vulnerability Ordinal="1"/></cvrfdoc>',
       '<cvrfdoc><Vulnerability Ordinal="1"><Threats>text</Threats><Notes/><Remediations>r</Remediations></Vulnerability></cvrfdoc>']


def test_each_table_is_the_same_from_its_own_parts(spark):
    texts = spark.createDataFrame([(f"m{i}", x) for i, x in enumerate([XML, *ODD])], "label string, xml string")
    whole = shred.vulnerabilities(parse_bulletin_text(texts, "xml", "label"))
    for name in shred.CHILDREN:
        cut = shred.vulnerabilities(parse_bulletin_text(texts, "xml", "label", shred.schema_for(name)))
        of = getattr(shred, name)
        assert sorted(of(cut).collect(), key=str) == sorted(of(whole).collect(), key=str), name
        assert of(whole).count() > 0, name


def test_selected_keeps_order_and_whole_ends():
    got = schemas.selected(schemas.DOCUMENT, ["Vulnerability.CWE", "Vulnerability._Ordinal", "DocumentTitle"])
    assert got.fieldNames() == ["DocumentTitle", "Vulnerability"]
    assert got["Vulnerability"].dataType.elementType.fieldNames() == ["_Ordinal", "CWE"]
    assert got["Vulnerability"].dataType.elementType["CWE"] == schemas.VULNERABILITY["CWE"]


def test_line_queries_parse_only_their_parts(spark):
    for name, absent in (("xml_threats", "Remediation"), ("xml_first_child", "Remediation"), ("xml_all_children", "ScoreSet"),
                         ("xml_position_key", "Remediation"), ("xml_roundtrip_lines", "Remediation")):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        parsed = plan[plan.index("from_xml("):].partition("to_xml(")[0]
        assert "Vulnerability" in parsed and f"StructField({absent}" not in parsed, name


def test_the_mart_is_the_same_from_its_own_parts(spark):
    from patchlens.plans.marts import IN_DOCUMENT, cve_mart_in_document
    texts = spark.createDataFrame([(f"m{i}", x) for i, x in enumerate([XML, *ODD])], "label string, xml string")
    cut = schemas.selected(schemas.DOCUMENT, IN_DOCUMENT)
    of_cut, of_whole = (sorted(cve_mart_in_document(parse_bulletin_text(texts, "xml", "label", schema), "2024-01-01").collect(), key=str)
                        for schema in (cut, schemas.DOCUMENT))
    assert of_cut == of_whole and len(of_whole) > 2
    plan = QUERIES["xml_cve_mart"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    parsed = plan[plan.index("from_xml("):].partition("to_xml(")[0]
    assert "StructField(FixedBuild" in parsed
    for absent in ("URL", "Vector", "Acknowledgment", "ProductTree", "_cpe-lang", "DocumentNotes", "SubType"):
        assert f"StructField({absent}" not in parsed, absent
