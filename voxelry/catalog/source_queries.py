"""Queries of subject lists, acquisitions, descriptors and appended tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import stage_path
from ..sources import descriptors, subjects, tables
from ..sources.stages import StageStore
from . import recipe as V
from .registry import query
from .sqltext import VOX, sql


@query("select_subjects", sql("""SELECT DISTINCT l_suppkey::VARCHAR AS subject_id FROM lineitem WHERE l_suppkey IN (SELECT o_custkey FROM orders)
 AND l_suppkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)"""))
def select_subjects(spark, d):
    """Included by a text list made of the orders, excluded by one made of the customers in debt."""
    available = V.table(spark, d, "lineitem").select(F.col("l_suppkey").cast("string").alias("subject_id"))
    listed = V.table(spark, d, "orders").select(F.concat_ws("; ", F.lit(" "), F.col("o_custkey").cast("string")).alias("text"))
    debt = V.table(spark, d, "customer").filter("c_acctbal < 0").select(F.concat(F.col("c_custkey").cast("string"), F.lit(" | ")).alias("text"))
    return subjects.select_subjects(available, subjects.split_subjects(listed), subjects.split_subjects(debt))


@query("missing_preproc", sql("SELECT c_custkey AS subject_id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')"))
def missing_preproc(spark, d):
    wanted = V.table(spark, d, "customer").select(F.col("c_custkey").alias("subject_id"))
    stored = V.table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("subject_id"))
    return subjects.missing_subjects(wanted, stored)


NEED_ROWS = ", ".join(f"('{p}', '{r}', '{'t2' if r == 't1' else r}')" for p in ("PVS", "WMH", "CMB") for r in subjects.NEEDS[p])


@query("required_acquisitions", sql(f"""SELECT subject_id, prediction, role, acq, coalesce(present, false) AS present FROM (SELECT * FROM (SELECT DISTINCT subject_id FROM have), (VALUES {NEED_ROWS}) n(prediction, role, acq))
 LEFT JOIN (SELECT DISTINCT *, true AS present FROM have) USING (subject_id, acq)""", have="SELECT o_custkey AS subject_id, ['t2', 'flair', 'swi', 'seg', 't1'][1 + o_orderkey % 5] AS acq FROM orders"))
def required_acquisitions(spark, d):
    """Each order is a scan of its customer; T2 stands in for T1."""
    acq = F.get(F.array(*map(F.lit, ["t2", "flair", "swi", "seg", "t1"])), (F.col("o_orderkey") % 5).cast("int"))
    scans = V.table(spark, d, "orders").select(F.col("o_custkey").alias("subject_id"), acq.alias("acq"))
    return subjects.required_acquisitions(scans, ["PVS", "WMH", "CMB"], {"t1": "t2"})


# documents play the files of model folders; ten documents make a folder
FOLDERS = ["T1-PVS", "T1.FLAIR-PVS", "T1.FLAIR-WMH", "SWI-CMB", "T2S-brainmask", "T1.FLAIR-LAC", "T1-PVS.WMH", "unnamed"]
FILES = {"files": f"SELECT {FOLDERS}[1 + (doc_id // 10) % {len(FOLDERS)}] || '/' || (doc_id // 10) AS folder, doc_id, CASE WHEN doc_id % 10 = 9 THEN 'model_' || doc_id || '.py' ELSE 'fold_' || doc_id END AS name, md5(text) AS md5 FROM documents"}


def model_files(spark, d):
    docs = V.table(spark, d, "documents")
    names = F.array(*map(F.lit, FOLDERS))
    group = F.expr("doc_id div 10")
    folder = F.concat(F.get(names, (group % len(FOLDERS)).cast("int")), F.lit("/"), group.cast("string"))
    key = F.col("doc_id").cast("string")
    name = F.when(F.col("doc_id") % 10 == 9, F.concat(F.lit("model_"), key, F.lit(".py"))).otherwise(F.concat(F.lit("fold_"), key))
    return docs.select(folder.alias("folder"), "doc_id", name.alias("name"), F.md5("text").alias("md5"), "text")


@query("verify_model_files", sql("""SELECT coalesce(l.name, f.name) AS name, l.md5 AS listed_md5, f.md5 AS found_md5, CASE WHEN f.md5 IS NULL THEN 'missing' WHEN l.md5 IS NULL THEN 'unlisted'
 WHEN l.md5 <> f.md5 THEN 'mismatch' ELSE 'ok' END AS status FROM (SELECT name, CASE WHEN doc_id % 7 = 0 THEN md5('x' || md5) ELSE md5 END AS md5 FROM files WHERE doc_id % 11 <> 0) l
 FULL JOIN (SELECT name, md5 FROM files WHERE doc_id % 13 <> 0) f ON l.name = f.name""", **FILES))
def verify_model_files(spark, d):
    files = model_files(spark, d)
    changed = F.when(F.col("doc_id") % 7 == 0, F.md5(F.concat(F.lit("x"), "md5"))).otherwise(F.col("md5"))
    listed = files.filter("doc_id % 11 <> 0").select("name", changed.alias("md5"))
    return descriptors.verify_model_files(listed, files.filter("doc_id % 13 <> 0"))


@query("build_descriptor", sql("""SELECT folder, target, modalities, files, script, CASE WHEN target IS NULL THEN 'no single target' WHEN modalities = '' THEN 'no modality' ELSE 'ok' END AS status FROM (
 SELECT folder, CASE split_part(folder, '/', 1) WHEN 'T1-PVS' THEN 'PVS' WHEN 'T1.FLAIR-PVS' THEN 'PVS' WHEN 'T1.FLAIR-WMH' THEN 'WMH' WHEN 'SWI-CMB' THEN 'CMB' WHEN 'T2S-brainmask' THEN 'brain_mask'
 WHEN 'T1.FLAIR-LAC' THEN 'LAC' END AS target, CASE split_part(folder, '/', 1) WHEN 'T1-PVS' THEN 't1' WHEN 'T1-PVS.WMH' THEN 't1' WHEN 'SWI-CMB' THEN 'swi' WHEN 'T2S-brainmask' THEN 't2,t2s'
 WHEN 'unnamed' THEN '' ELSE 't1,flair' END AS modalities, string_agg(name || ':' || md5, ' ' ORDER BY name) FILTER (NOT name LIKE '%.py') AS files, max(name) FILTER (name LIKE '%.py') AS script
 FROM files GROUP BY 1)""", **FILES))
def build_descriptor(spark, d):
    out = descriptors.build_descriptor(model_files(spark, d).select("folder", "name", "md5"))
    listed = F.transform("files", lambda f: F.concat_ws(":", f["name"], f["md5"]))
    return out.select("folder", "target", F.array_join("modalities", ",").alias("modalities"), F.array_join(listed, " ").alias("files"), F.col("script.name").alias("script"), "status")


@query("directory_checksums", sql("SELECT folder, md5(string_agg(text, '' ORDER BY name)) AS md5, count(*) AS n_files FROM files JOIN documents USING (doc_id) GROUP BY 1", **FILES))
def directory_checksums(spark, d):
    return descriptors.directory_checksums(model_files(spark, d), content="text")


@query("append_with_date", sql("""SELECT o_custkey AS subject_id, o_totalprice AS total, NULL::VARCHAR AS segment, o_orderdate::DATE::VARCHAR AS append_date FROM orders
 UNION ALL SELECT c_custkey, c_acctbal, c_mktsegment, '2024-05-06' FROM customer"""))
def append_with_date(spark, d):
    history = V.table(spark, d, "orders").select(F.col("o_custkey").alias("subject_id"), F.col("o_totalprice").alias("total"), F.to_date("o_orderdate").alias("append_date"))
    rows = V.table(spark, d, "customer").select(F.col("c_custkey").alias("subject_id"), F.col("c_acctbal").alias("total"), F.col("c_mktsegment").alias("segment"))
    return tables.appended(history, rows, "2024-05-06").withColumn("append_date", F.col("append_date").cast("string"))


@query("read_subject_csvs", sql("""SELECT (doc_id // 20)::VARCHAR AS subject_id, doc_id::VARCHAR AS doc_id, nullif(lang, '') AS lang, CASE WHEN doc_id // 20 % 2 = 1 THEN nullif(source, '') END AS source,
 nullif(text, '') AS text FROM documents"""))
def read_subject_csvs(spark, d):
    """Every twenty documents are the table of a participant, their whole texts quoted cells with line ends; odd participants have a column more and another order."""
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    docs = V.table(spark, d, "documents").withColumn("subject_id", F.expr("doc_id div 20"))
    odd = F.col("subject_id") % 2 == 1
    cells = F.when(odd, F.concat_ws(",", "doc_id", quoted(F.col("text")), quoted(F.col("lang")), quoted(F.col("source")))).otherwise(
        F.concat_ws(",", quoted(F.col("lang")), quoted(F.col("text")), "doc_id"))
    head = F.when(F.first(odd), "doc_id,text,lang,source").otherwise("Lang,Text,doc_id")
    path = stage_path(spark, "subject-tables")
    (docs.groupBy("subject_id").agg(F.concat(head, F.lit("\n"), F.array_join(F.collect_list(cells), "\n")).alias("value"))
     .write.partitionBy("subject_id").text(path))
    out = tables.read_subject_csvs(spark, path + "/*/*.txt", r"subject_id=([^/]+)/")
    return out.select("subject_id", "doc_id", F.col("lang").alias("lang"), "source", F.col("text").alias("text"))


@query("stage_store_resume", sql(f"SELECT {VOX}, v, CASE WHEN subject_id % 2 = 0 AND subject_id % 20 <> 4 THEN 'before' WHEN subject_id % 20 = 4 THEN 'repeated' ELSE 'resumed' END AS made FROM prob"))
def stage_store_resume(spark, d):
    """A half-finished run: even subjects are complete, some of them by a second write, and rows of a lost write lie about; only the others are made anew."""
    store, everyone, rows = StageStore(spark, stage_path(spark, "stage-store"), 16), V.subjects(spark, d), V.prob(spark, d).select("subject_id", "i", "j", "k", "v")
    of = lambda rule, made: rows.filter(rule).withColumn("made", F.lit(made))
    store.write("maps", of("subject_id % 2 = 0", "before"), everyone.filter("subject_id % 2 = 0"))
    store.write_data("maps", of("subject_id % 5 = 0", "lost"))
    store.write("maps", of("subject_id % 20 = 4", "repeated"), everyone.filter("subject_id % 20 = 4"))
    return store.resume("maps", everyone, lambda todo: rows.join(todo, "subject_id", "left_semi").withColumn("made", F.lit("resumed")))
