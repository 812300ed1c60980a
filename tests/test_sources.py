"""XML / TSV / line sources on hand-written fixtures."""

from ferret.operators import index as I
from ferret.operators import search as S
from ferret.sources import sinks
from ferret.sources import xml as X

RECORDS = """<?xml version="1.0" encoding="UTF-8"?>
<dblp>
<article key="journals/x/A1"><author>Ann One</author><author>Bob Two</author>
<title>On <i>Kettle</i> Design.</title><journal>J. Data</journal><year>2013</year><ee>e</ee></article>
<inproceedings key="conf/y/B2"><title>Caf&#233; &amp; Search</title><booktitle>SIGIR</booktitle><year>2010</year>
<pages>1-2</pages></inproceedings>
<article key="journals/x/C3"><author>Cid</author><title></title><journal>J. Data</journal></article>
<book key="books/z/D4"><title>Ignored Book</title><year>2001</year></book>
</dblp>
"""

HITS = """<?xml version="1.0" encoding="UTF-8"?>
<result><hits total="3">
<hit score="3" id="1"><info><title>T1</title><type>Conference and Workshop Papers</type>
<url>http://dblp.org/rec/conf/a/K1</url></info></hit>
<hit score="3" id="2"><info><title>T2</title><type>Books and Theses</type><url>http://dblp.org/rec/books/K2</url></info></hit>
<hit score="2" id="3"><info><title>T3</title><type>Journal Articles</type><url>http://dblp.org/rec/journals/K3</url></info></hit>
</hits></result>
"""

TOPICS = """<topics><top><num>1</num><title>Garden Walls</title><query>title:garden walls</query>
<desc>d</desc><narr>n</narr></top><top><num>3</num><title>Q</title><query>copper kettle 1987</query>
<desc>d</desc><narr></narr></top></topics>"""


def test_records(spark, tmp_path):
    p = tmp_path / "r.xml"
    p.write_text(RECORDS, encoding="utf-8")
    rec = X.clean_records(X.read_xml_records(spark, str(p)))
    rows = {r.id: r for r in rec.collect()}
    assert set(rows) == {"journals/x/A1", "conf/y/B2", "journals/x/C3"}  # book ignored
    a = rows["journals/x/A1"]
    assert a.title == "On Kettle Design." and a.authors == ["Ann One", "Bob Two"] and a.venue == "J. Data"
    assert rows["conf/y/B2"].title == "Café & Search" and rows["conf/y/B2"].venue == "SIGIR"
    assert rows["conf/y/B2"].authors == []
    ok, bad = X.split_rejects(rec)
    assert [r.id for r in bad.collect()] == ["journals/x/C3"] and ok.count() == 2


ODD = """<?xml version="1.0" encoding="UTF-8"?>
<!DOCTYPE dblp SYSTEM "dblp.dtd">
<dblp>
<article><author>No Key</author><title>Keyless first</title></article>
<article mdate="2020-01-01" key="journals/x/U1" publtype="informal"><author>J&uuml;rgen One</author><author>Bob Two</author>
<title>Copper &amp; Tin &lt;alloys&gt;</title><journal>J. Caf&eacute;</journal><year>2013</year><pages>7&ndash;9</pages></article>
<book key="books/z/D4"><title>Ignored Book</title><year>2001</year></book>
<inproceedings key='conf/y/Q2'><title>Rivers of AT & T &nosuch; H&#228;fen</title><booktitle>SIGIR</booktitle><year>2010</year></inproceedings>
<article><title>Keyless</title></article>
<article key=""><title>Empty key</title></article>
<article key="journals/x/T3"><author>Cid</author><title>Torn</article>
<article key="journals/x/O4"><title>Never closed</title>
<inproceedings key="conf/y/L5" mdate="2020"><author>Ann One</author><title>Last of <sub>all</sub></title><year>2011</year></inproceedings>
</dblp>
"""


def test_odd_records_to_hits(spark, tmp_path):
    """Entities without a DTD, keyless, torn and unclosed records, many splits:
    the same rows, and an accented author is found."""
    p = tmp_path / "odd.xml"
    p.write_text(ODD, encoding="utf-8")
    (tmp_path / "latin.xml").write_bytes(ODD.encode("latin-1"))
    key = "spark.sql.files.maxPartitionBytes"
    rows = []
    for split, path, enc in (("134217728", p, "UTF-8"), ("100", p, "UTF-8"), ("100", tmp_path / "latin.xml", "ISO-8859-1")):
        spark.conf.set(key, split)
        try:
            raw = X.read_xml_records(spark, str(path), encoding=enc)
            assert raw.rdd.getNumPartitions() > 1 or split != "100"
            ok, bad = X.split_rejects(X.clean_records(raw))
            rows.append((sorted(ok.collect()), sorted((r.reason, r._corrupt_record) for r in bad.na.fill("").collect())))
        finally:
            spark.conf.unset(key)
    assert rows[0] == rows[1] == rows[2]
    by = {r.id: r for r in rows[0][0]}
    assert set(by) == {"journals/x/U1", "conf/y/Q2", "conf/y/L5"}
    one = by["journals/x/U1"]
    assert one.authors == ["Jürgen One", "Bob Two"] and one.title == "Copper & Tin <alloys>" and one.venue == "J. Café"
    assert one.content == "Jürgen One Bob Two Copper & Tin <alloys> J. Café 2013 7–9"
    assert by["conf/y/Q2"].title == "Rivers of AT & T &nosuch; Häfen" and by["conf/y/L5"].title == "Last of all"
    assert by["conf/y/Q2"].content == "Rivers of AT & T &nosuch; Häfen SIGIR 2010"
    reasons = [r for r, _ in rows[0][1]]
    assert reasons == ["malformed"] * 2 + ["missing key"] * 3
    assert all(len(text) < 120 for _, text in rows[0][1])  # a rejected row holds its own text only
    I.write(I.index_records(X.split_rejects(X.clean_records(X.read_xml_records(spark, str(p))))[0]), str(tmp_path / "ix"))
    ix = I.read(spark, str(tmp_path / "ix"))
    q = spark.createDataFrame([(1, "", {"authors": "jürgen"}), (2, "rivers", {}), (3, "", {"authors": '"one bob"'}), (4, "copper 2013", {})],
                              "qid int, query string, adv map<string,string>")
    hits = {(r.qid, r.rank): r.doc_id for r in S.search(ix, q).collect()}
    # a phrase clause is its terms and, boosted, the phrase: "one" alone comes second
    assert hits == {(1, 1): "journals/x/U1", (2, 1): "conf/y/Q2", (3, 1): "journals/x/U1", (3, 2): "conf/y/L5",
                    (4, 1): "journals/x/U1"}


def test_sinks(spark, tmp_path):
    q = spark.createDataFrame([(1, 0, "journals/a/X1", 1), (2, 0, "b", 0)], "topic int, iteration int, document string, relevancy int")
    for by_topic in (True, False):
        path = str(tmp_path / f"qrels{by_topic}")
        sinks.write_qrels(q, path, by_topic)
        back = X.read_qrels(spark, path + ("/t=*" if by_topic else ""))
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, q.collect()))
    sinks.write_lines(q, "document", str(tmp_path / "keys"))
    assert sorted(r.value for r in X.read_lines(spark, str(tmp_path / "keys")).collect()) == ["b", "journals/a/X1"]
    sinks.write_report(q, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).count() == 2


def test_hits(spark, tmp_path):
    p = tmp_path / "h.xml"
    p.write_text(HITS, encoding="utf-8")
    rows = sorted((r.key, r.score) for r in X.read_hits(spark, str(p)).collect())
    assert rows == [("conf/a/K1", 3), ("journals/K3", 2)]
    (tmp_path / "more.xml").write_text(HITS.replace('total="3"', 'total="1200"'), encoding="utf-8")
    totals = X.read_hit_totals(spark, str(tmp_path / "*.xml")).collect()
    assert sorted((r.file.rsplit("/", 1)[1], r.total) for r in totals) == [("h.xml", 3), ("more.xml", 1200)]


def test_topics(spark, tmp_path):
    p = tmp_path / "t.xml"
    p.write_text(TOPICS, encoding="utf-8")
    rows = sorted((r.num, r.query) for r in X.read_topics(spark, str(p)).collect())
    assert rows == [(1, "title:garden walls"), (3, "copper kettle 1987")]


def test_qrels_and_lines(spark, tmp_path):
    (tmp_path / "q1.txt").write_text("1\t0\tjournals/a/X1\t 1\n1\t0\tjournals/a/X2\t 0\nTOPIC_NUM\t0\tk\t \n")
    q = X.relevant(X.read_qrels(spark, str(tmp_path / "q*.txt"))).collect()
    assert [(r.topic, r.document) for r in q] == [(1, "journals/a/X1")]
    (tmp_path / "l.txt").write_text("a\n\nthe\n")
    assert sorted(r.value for r in X.read_lines(spark, str(tmp_path / "l.txt")).collect()) == ["a", "the"]
