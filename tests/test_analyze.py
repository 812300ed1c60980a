import duckdb
from pyspark.sql import functions as F

from ferret.functions import analyze as A
from ferret.functions import porter

GOLDENS = [tuple(p.split()) for p in """caresses caress;ponies poni;ties ti;caress caress;cats cat;feed feed;
agreed agre;plastered plaster;bled bled;motoring motor;sing sing;conflated conflat;troubled troubl;sized size;
hopping hop;tanned tan;falling fall;hissing hiss;fizzed fizz;failing fail;filing file;happy happi;sky sky;
relational relat;conditional condit;rational ration;valenci valenc;hesitanci hesit;digitizer digit;
conformabli conform;radicalli radic;differentli differ;vileli vile;analogousli analog;vietnamization vietnam;
predication predic;operator oper;feudalism feudal;decisiveness decis;hopefulness hope;callousness callous;
formaliti formal;sensitiviti sensit;sensibiliti sensibl;triplicate triplic;formative form;formalize formal;
electriciti electr;electrical electr;hopeful hope;goodness good;revival reviv;allowance allow;inference infer;
airliner airlin;gyroscopic gyroscop;adjustable adjust;defensible defens;irritant irrit;replacement replac;
adjustment adjust;dependent depend;adoption adopt;homologou homolog;communism commun;activate activ;
angulariti angular;homologous homolog;effective effect;bowdlerize bowdler;probate probat;rate rate;cease ceas;
controll control;roll roll;generalization gener;oscillators oscil;this thi;was wa;is is""".replace("\n", "").split(";")]


def test_porter_spark(spark):
    df = spark.createDataFrame(GOLDENS, "w string, want string")
    got = porter.stem_df(df, "w", "got").collect()
    bad = [(r.w, r.want, r.got) for r in got if r.want != r.got]
    assert not bad


def test_porter_duckdb_same_rules():
    vals = ",".join(f"('{a}','{b}')" for a, b in GOLDENS)
    rows = duckdb.sql(porter.stem_sql(f"SELECT * FROM (VALUES {vals}) t(w, want)", "w", "got")).fetchall()
    assert all(r[1] == r[2] for r in rows)


def test_stop_after_stem(spark):
    """Stemmed stop words escape the stop filter: 'this was' -> 'thi wa'."""
    df = spark.createDataFrame([("this was",)], "t string")
    tok = A.explode_tokens(df, "t", [])
    out = [r.term for r in A.analyze_tokens(tok, A.Analyzer(True, True, True)).orderBy("pos").collect()]
    assert out == ["thi", "wa"]


def test_tokenizer(spark):
    df = spark.createDataFrame([("auto-completion don't 3.5 Über_x",)], "t string")
    toks = df.select(A.tokenize(F.col("t")).alias("a")).first().a
    assert toks == ["auto", "completion", "don't", "3.5", "Über_x"]


def test_stop_positions_keep_holes(spark):
    df = spark.createDataFrame([("the information of retrieval",)], "t string")
    tok = A.explode_tokens(df, "t", [])
    rows = [(r.pos, r.term) for r in A.analyze_tokens(tok, A.STANDARD).orderBy("pos").collect()]
    assert rows == [(1, "information"), (3, "retrieval")]


def test_spark_stop_lists_available():
    assert len(A.spark_stop_words("english")) > 100


def test_analyzers_per_field_and_custom_filters(spark):
    """A map of analyzers by field, with a caller's token filter, in the index
    and in the query."""
    from pyspark.sql import functions as F

    from ferret.operators import index as I
    from ferret.operators import search as S

    no_digits = ("no_digits", lambda c: F.when(~c.rlike(r"^\d+$"), c))
    cut = ("cut4", lambda c: F.substring(c, 1, 4))
    an = {"content": A.Analyzer(stemming=True, filters=(no_digits,)), "venue": A.Analyzer(lowercase=False, stopwords=False), "authors": A.Analyzer(filters=(cut,))}
    rec = spark.createDataFrame([(1, "Running Dogs", "running dogs 1987 the", "The VLDB", "1987", ["Ann Robertson", "Bo"]), (2, "A cat", "runs 12", "kdd", "1988", [])],
                                "doc_id long, title string, content string, venue string, year string, authors array<string>")
    ix = I.index_records(rec, an)
    got = {f: set() for f in I.FIELDS}
    for r in ix.postings.filter("doc_id = 1").collect():
        got[r.field].add(r.term)
    assert got == {"title": {"running", "dogs"}, "content": {"run", "dog"}, "venue": {"The", "VLDB"}, "year": {"1987"}, "authors": {"ann", "robe", "bo"}}
    q = spark.createDataFrame([(1, "RUNNING 1987", None), (2, "", {"authors": "robertshaw"}), (3, "", {"venue": "vldb"})], "qid int, query string, adv map<string,string>")
    hits = {(r.qid, r.doc_id) for r in S.search(ix, q, title_an=an).collect()}
    assert hits == {(1, 1), (1, 2), (2, 1)}
    assert A.key_of(an) != A.key_of(dict(an, content=A.STANDARD)) and A.key_of(A.STANDARD) == A.STANDARD.key
