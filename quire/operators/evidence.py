"""Evidence that is bound to content by hashes: strict JSON, paths, manifests, editorial overrides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text
from quire.operators import blocks

SHA256, COMMIT = r"^[0-9a-f]{64}\z", r"^[0-9a-fA-F]{7,64}\z"
ROOT = ("docs", "english-corrections")


def strict_json(doc: Column) -> Column:
    """The VARIANT of a document; null for malformed ones, duplicate keys at any depth, NaN and infinities."""
    return F.try_parse_json(doc)


def is_digest(value: Column) -> Column:
    return F.coalesce(value.rlike(SHA256), F.lit(False))


def is_commit(value: Column) -> Column:
    return F.coalesce(value.rlike(COMMIT), F.lit(False))


def is_safe_path(path: Column) -> Column:
    """Relative, without drive, backslash, control characters, or empty, "." and ".." parts."""
    plain = ~path.rlike(r"[\\\\:\x00-\x1F]")
    return F.coalesce(plain & F.forall(F.split(path, "/", -1), lambda p: ~p.isin("", ".", "..")), F.lit(False))


def is_provenance_path(path: Column) -> Column:
    """A safe path below the folder of corrections whose parts end in neither a dot nor a space."""
    parts = F.split(path, "/", -1)
    below = (F.size(parts) >= 3) & (F.get(parts, F.lit(0)) == ROOT[0]) & (F.get(parts, F.lit(1)) == ROOT[1])
    return is_safe_path(path) & below & F.forall(parts, lambda p: ~p.rlike(r"[. ]\z"))


def target_parts(content: Column) -> Column:
    """(prefix, arabic, english, problem) of a two-block file; the prefix holds all bytes before the second heading."""
    t = F.regexp_replace(content, "\r\n", "\n")
    bs = blocks.parse_context(t)
    a, e = blocks.body_of(bs, "Arabic"), blocks.body_of(bs, "English")
    problem = (
        F.when(blocks.labels_of(bs) != F.array(F.lit("Arabic"), F.lit("English")), "expected exactly Arabic and English blocks in order")
        .when(~t.startswith("Arabic:\n") | (F.regexp_count(t, F.lit(r"(?m)^English:[ \t]*(?:\n|\z)")) != 1), "expected canonical standalone headings")
        .when((a == "") | (e == ""), "bodies must not be empty")
    )
    return F.struct(F.regexp_extract(t, r"(?s)\A(.*?)^English:".replace("(?s)", "(?ms)"), 1).alias("prefix"), a.alias("arabic"), e.alias("english"), problem.alias("problem"))


def override_entry(page: Column, boundary: Column, authorized_at: Column, source: Column, previous: Column, corrected: Column, provenance: Column) -> Column:
    """(entry, problem) of an editorial override; files are strings as read, provenance is an array of (path, content)."""
    was, now = target_parts(previous), target_parts(corrected)
    lf = lambda c: F.regexp_replace(c, "\r\n", "\n")
    src = text.strip(lf(source))
    problem = F.coalesce(
        F.when(~page.between(1, 604) | ~boundary.between(1, 604), F.lit("pages must be in 1..604")),
        F.when(text.strip(authorized_at) == "", F.lit("authorized_at must be supplied")),
        F.when(F.size(provenance) == 0, F.lit("nonempty provenance is required")),
        F.when(~F.forall(provenance, lambda p: is_provenance_path(p["path"])), F.lit("provenance must be relative under the corrections folder")),
        was["problem"], now["problem"],
        F.when(was["prefix"] != now["prefix"], F.lit("prefix changed beyond CRLF normalization")),
        F.when((now["arabic"] != src) | (was["arabic"] != src), F.lit("embedded source differs from the canonical one")),
    )
    evidence = F.transform(provenance, lambda p: F.struct(p["path"].alias("path"), F.sha2(p["content"], 256).alias("sha256"), F.sha2(lf(p["content"]), 256).alias("normalized_sha256")))
    entry = F.struct(
        page.alias("page"), boundary.alias("boundary_page"), authorized_at.alias("authorized_at"), F.lit("user_editorial_override").alias("kind"), F.lit(False).alias("source_verified"),
        F.sha2(source, 256).alias("source_sha256"), F.sha2(lf(previous), 256).alias("previous_en_sha256"), F.sha2(lf(corrected), 256).alias("en_sha256"),
        F.sha2(corrected, 256).alias("observed_raw_en_sha256"), F.sha2(now["prefix"], 256).alias("arabic_prefix_sha256"), evidence.alias("provenance"),
    )
    return F.struct(F.when(problem.isNull(), entry).alias("entry"), problem.alias("problem"))


def override_matches(entry: Column, page: Column, source: Column, target: Column) -> Column:
    """Whether a registered override still describes this page's source and target; anything missing fails."""
    now, lf = target_parts(target), lambda c: F.regexp_replace(c, "\r\n", "\n")
    hashes = ("source_sha256", "previous_en_sha256", "en_sha256", "observed_raw_en_sha256", "arabic_prefix_sha256")
    ok = (entry["kind"] == "user_editorial_override") & ~entry["source_verified"] & (entry["page"] == page) & entry["boundary_page"].between(1, 604)
    for h in hashes:
        ok = ok & is_digest(entry[h])
    ok = ok & (text.strip(entry["authorized_at"]) != "") & (F.size(entry["provenance"]) > 0)
    ok = ok & F.forall(entry["provenance"], lambda p: is_provenance_path(p["path"]) & is_digest(p["sha256"]) & is_digest(p["normalized_sha256"]))
    ok = ok & now["problem"].isNull() & (entry["source_sha256"] == F.sha2(source, 256)) & (entry["en_sha256"] == F.sha2(lf(target), 256))
    ok = ok & (entry["arabic_prefix_sha256"] == F.sha2(now["prefix"], 256)) & (now["arabic"] == text.strip(lf(source)))
    return F.coalesce(ok, F.lit(False))


WAIVABLE = ("untranslated", "banned-honorific", "missing-honorific")


def waive(findings: DataFrame, matching: DataFrame) -> DataFrame:
    """findings with `waived`: style findings of the en layer on pages whose override matches."""
    m = matching.select(F.col("page").alias("m_page")).distinct()
    can = (F.col("layer") == "en") & F.col("rule").isin(*WAIVABLE)
    return findings.join(m, F.col("page") == F.col("m_page"), "left").withColumn("waived", can & F.col("m_page").isNotNull()).drop("m_page")


def manifest_audit(manifest: DataFrame, files: DataFrame, records: DataFrame, last_page: int = 67) -> DataFrame:
    """(page, errors) of a manifest (page, role, path, sha256) against files (path, content) and dataset records (page, record_sha256), with the record hash in manifest rows of role "record".

    Pages must be 1..last_page; each entry needs a safe path, a digest and a file whose bytes have it.
    """
    here = files.select(F.col("path").alias("f_path"), F.sha2("content", 256).alias("f_sha"))
    rows = manifest.join(here, F.col("path") == F.col("f_path"), "left")
    rec = records.select(F.col("page").alias("r_page"), F.col("record_sha256").alias("r_sha"))
    rows = rows.join(rec, F.col("page") == F.col("r_page"), "left")
    is_record = F.col("role") == "record"
    problem = (
        F.when(~F.col("page").between(1, last_page), "page out of scope").when(~is_digest(F.col("sha256")), "malformed digest")
        .when(is_record & F.col("r_sha").isNull(), "record missing").when(is_record & (F.col("r_sha") != F.col("sha256")), "record differs")
        .when(~is_record & ~is_safe_path(F.col("path")), "unsafe path").when(~is_record & F.col("f_sha").isNull(), "file missing")
        .when(~is_record & (F.col("f_sha") != F.col("sha256")), "file differs")
    )
    found = rows.select("page", F.concat_ws(": ", "role", problem).alias("error"), problem.isNotNull().alias("bad"))
    spine = manifest.sparkSession.range(1, last_page + 1).select(F.col("id").alias("s_page"))
    lost = spine.join(manifest.select("page").distinct(), F.col("s_page") == F.col("page"), "left_anti").select(F.col("s_page").alias("page"), F.lit("page missing from manifest").alias("error"), F.lit(True).alias("bad"))
    every = found.unionByName(lost)
    return every.groupBy("page").agg(F.array_sort(F.array_compact(F.collect_list(F.when(F.col("bad"), F.col("error"))))).alias("errors"))


def receipts(reports: DataFrame, files: DataFrame, worker: str, reviewer: str) -> DataFrame:
    """(page, receipt): validator report and hashes of the page's files (page, path, content), as a struct."""
    hashes = files.groupBy(F.col("page").alias("h_page")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("path", F.sha2("content", 256).alias("sha"))))).alias("file_hashes"))
    rows = reports.filter("ok").join(hashes, F.col("page") == F.col("h_page"), "left")
    return rows.select("page", F.struct(F.lit(1).alias("schema_version"), F.lit("verification_receipt").alias("type"), F.lit(worker).alias("worker_id"), F.lit(reviewer).alias("reviewer"), F.struct(*reports.columns).alias("validator"), "file_hashes").alias("receipt"))
