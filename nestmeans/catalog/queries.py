"""Every operator as a query over the given tables.

A query takes (spark, folder of the Parquet tables) and returns a DataFrame. ``oracles`` holds
the matching SQL. Sinks are checked by reading back what they wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestmeans.functions.text import largest_fragment, smiles_like, stem
from nestmeans.functions.vectors import cast_vector, is_binary, on_bits, popcount, squared_l2, to_dense
from nestmeans.operators import clusters, fingerprints, kmeans, normalize, ordinals, union
from nestmeans.operators import profile as profiles
from nestmeans.options import FingerprintOptions, HierarchyOptions, KMeansOptions
from nestmeans.plans import hierarchy
from nestmeans.schemas import vector_contract
from nestmeans.scratch import materialize, scratch_path
from nestmeans.sources import files, sinks

# Settings shared with the oracles.
FIT_K, FIT_ITER = 8, 3
K1, STAGE_ITER, RATIO, BASE_K = 4, 2, 8.0, 2
DOC_BITS = 512
SAMPLED = 10
SCALE = 10_000  # one grid for both engines

FIT = KMeansOptions(max_iter=FIT_ITER, scale=SCALE)
ONE = KMeansOptions(max_iter=1, scale=SCALE)
STAGE = KMeansOptions(max_iter=STAGE_ITER, scale=SCALE)
BROADCAST = {"local_bytes": 0}
STREAMED = {"local_bytes": 0, "broadcast_bytes": 0, "slice_bytes": 8 * 64 * 200}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def joined(vec) -> F.Column:
    """A vector as text, so that both engines compare the same value."""
    return F.concat_ws(",", F.transform(vec, lambda x: x.cast("string")))


# --- scans and lines ----------------------------------------------------------------------------


def document_lines(spark, folder) -> DataFrame:
    """Every line of every document."""
    docs = table(spark, folder, "documents")
    lines = docs.select("doc_id", "source", F.posexplode(F.split("text", "\n", -1)))
    return lines.select(
        (F.col("doc_id") * 1_000_000 + F.col("pos")).alias("row_id"),
        F.col("source").alias("source_file"),
        F.col("col").alias("value"),
    )


def lines_parse(spark, folder):
    lines = fingerprints.accepted_lines(document_lines(spark, folder))
    return lines.select("row_id", "smiles", "name")


def lines_parse_report(spark, folder):
    return fingerprints.fingerprint_report(document_lines(spark, folder))


def lines_valid_report(spark, folder):
    return fingerprints.fingerprint_report(document_lines(spark, folder), valid=smiles_like)


def _customer_files(spark, folder) -> str:
    """Customers as text files, one folder per market segment."""
    path = scratch_path(spark, "customers")
    sinks.write_preprocessed(
        table(spark, folder, "customer"), path, "c_name", "c_custkey", source="c_mktsegment"
    )
    return path


def _segment(path) -> F.Column:
    return F.regexp_extract(path, "c_mktsegment=([^/]+)/", 1).alias("segment")


def scan_lines(spark, folder):
    lines = files.scan_lines(spark, _customer_files(spark, folder), True, "*.csv")
    return fingerprints.accepted_lines(lines).select(_segment("source_file"), "smiles", "name")


def scan_delimited(spark, folder):
    path = _customer_files(spark, folder)
    rows = files.scan_delimited(spark, path, "c_name", "c_custkey", " ", "*.csv", "_taut")
    return rows.select(
        _segment("source_file"), "c_name", F.col("c_custkey").cast("bigint").alias("c_custkey")
    )


def find_files(spark, folder):
    found = files.find_files(spark, _customer_files(spark, folder), "*.csv", "_taut")
    return found.select(_segment("path")).distinct()


def find_files_excluded(spark, folder):
    """Segments up to F are packed files, which the exclusion text leaves out."""
    path = scratch_path(spark, "customers")
    rows = table(spark, folder, "customer").select("c_mktsegment", "c_name")
    for packed, some in ((True, rows.filter("c_mktsegment < 'F'")), (False, rows.filter("c_mktsegment >= 'F'"))):
        writer = some.write.mode("append").partitionBy("c_mktsegment")
        writer.csv(path, compression="gzip" if packed else "none")
    found = files.find_files(spark, path, "*.csv*", ".gz")
    return found.select(_segment("path")).distinct()


def file_stems(spark, folder):
    names = F.regexp_extract("url", "([^/]+)$", 1)
    return table(spark, folder, "pages").select("page_id", stem(names).alias("stem"))


# --- normalise and deduplicate ------------------------------------------------------------------


def normalize_fold(spark, folder):
    docs = normalize.normalize(table(spark, folder, "documents"), "text", "fold")
    return docs.select("doc_id", "canonical")


def normalize_fragment(spark, folder):
    docs = normalize.normalize(table(spark, folder, "documents"), "text", largest_fragment)
    return docs.select("doc_id", "canonical")


def normalize_smiles_tokens(spark, folder):
    parts = normalize.normalize(table(spark, folder, "part"), "p_name", "smiles_tokens")
    return parts.select("p_partkey", "canonical")


def dedup_per_source(spark, folder):
    return normalize.canonical_dedup(
        table(spark, folder, "documents"), "text", "doc_id", "fold", "doc_id", "source", "source"
    )


def dedup_global(spark, folder):
    return normalize.canonical_dedup(
        table(spark, folder, "documents"), "text", "doc_id", "fold", "doc_id", "global"
    )


def dedup_report(spark, folder):
    return normalize.preprocess_report(
        table(spark, folder, "documents"), "text", "fold", "source"
    )


# --- fingerprints -------------------------------------------------------------------------------


def _part_bits(spark, folder, **options) -> DataFrame:
    parts = table(spark, folder, "part")
    return fingerprints.add_fingerprint(parts, "p_name", FingerprintOptions(**options))


def fingerprint_qgram(spark, folder):
    return _part_bits(spark, folder).select("p_partkey", joined("fp").alias("fp"))


def fingerprint_features(spark, folder):
    bits = _part_bits(spark, folder, use_features=True)
    return bits.select("p_partkey", joined("fp").alias("fp"))


def fingerprint_token(spark, folder):
    docs = fingerprints.add_fingerprint(
        table(spark, folder, "documents"), "text", FingerprintOptions(fp_type="token")
    )
    return docs.select("doc_id", joined(on_bits("fp")).alias("on_bits"))


def fingerprint_documents(spark, folder):
    docs = fingerprints.add_fingerprint(
        table(spark, folder, "documents"), "text", FingerprintOptions(n_bits=DOC_BITS)
    )
    return docs.select(
        "doc_id",
        popcount("fp").cast("bigint").alias("ones"),
        is_binary("fp").alias("binary"),
        F.size("fp").cast("bigint").alias("width"),
        joined(on_bits("fp")).alias("on_bits"),
    )


def fingerprint_lines(spark, folder):
    rows = fingerprints.fingerprint_lines(document_lines(spark, folder), valid=smiles_like)
    return rows.select("row_id", "smiles", "name", joined(on_bits("fp")).alias("on_bits"))


def fingerprint_files(spark, folder):
    """Lines to a fingerprint table with one folder per source, read back as one table."""
    path = scratch_path(spark, "bits")
    rows = fingerprints.fingerprint_lines(document_lines(spark, folder), source="source_file")
    sinks.write_fingerprints(rows, path, source="source_file")
    back = spark.read.parquet(path)
    return back.select("source_file", "row_id", "name", popcount("fp").cast("bigint").alias("ones"))


def _named_bits(df, name, n_bits) -> DataFrame:
    bits = fingerprints.add_fingerprint(df, name, FingerprintOptions(n_bits=n_bits))
    return bits.select(F.col(name).alias("smiles"), F.col(df.columns[0]).alias("key"), "fp")


def fingerprint_union(spark, folder):
    """Two written tables, read as one with a column subset."""
    path = scratch_path(spark, "bits")
    for name, col in (("part", "p_name"), ("supplier", "s_name")):
        bits = _named_bits(table(spark, folder, name), col, 256)
        sinks.write_fingerprints(bits, f"{path}/{name}")
    rows = files.read_tables(spark, path, columns=["smiles", "fp", "no_such_column"])
    return rows.select("smiles", popcount("fp").cast("bigint").alias("ones"))


def _mixed_widths(spark, folder) -> DataFrame:
    rows = union.union_tables(
        {
            "part": _named_bits(table(spark, folder, "part"), "p_name", 256),
            "supplier": _named_bits(table(spark, folder, "supplier"), "s_name", 128),
            "customer": _named_bits(table(spark, folder, "customer"), "c_name", 256),
        },
        source="source",
    )
    return materialize(rows, "mixed")


def union_widths(spark, folder):
    return union.vector_widths(_mixed_widths(spark, folder), "source")


def union_compatible(spark, folder):
    rows = union.compatible_rows(_mixed_widths(spark, folder), "source", on_mismatch="drop")
    return rows.select("source", "key")


def union_tables(spark, folder):
    tables = {
        "part": table(spark, folder, "part").selectExpr("p_name as smiles", "p_partkey as key"),
        "supplier": table(spark, folder, "supplier")
        .selectExpr("s_suppkey as key", "s_name as smiles", "s_acctbal"),
    }
    return union.union_tables(tables, source="source")


def vector_check(spark, folder):
    return vector_contract(table(spark, folder, "embeddings"), "embedding")


def vector_cast(spark, folder):
    rows = table(spark, folder, "embeddings")
    grid = F.transform("embedding", lambda x: F.floor(x * 100))
    return rows.select("vec_id", joined(cast_vector(grid, "int16")).alias("v"))


def vector_distance(spark, folder):
    """Squared distance of every vector to the mirrored one; whole numbers, so exact."""
    grid = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000))
    rows = table(spark, folder, "embeddings").select("vec_id", grid.alias("v"))
    return rows.select("vec_id", squared_l2("v", F.reverse("v")).alias("dist"))


# --- k-means ------------------------------------------------------------------------------------


def _fit(spark, folder, **changes) -> DataFrame:
    options = KMeansOptions(**{"max_iter": FIT_ITER, "scale": SCALE, **changes})
    rows = table(spark, folder, "embeddings")
    return kmeans.kmeans_fit(rows, FIT_K, "embedding", "vec_id", options)


def _model_text(model: DataFrame) -> DataFrame:
    grid = F.transform("centroid", lambda x: F.floor(x * 10_000 + 0.5))
    return model.select(
        F.col("cluster").cast("bigint").alias("cluster"), joined(grid).alias("centroid"), "n"
    )


def kmeans_fit(spark, folder):
    return _model_text(_fit(spark, folder))


def kmeans_fit_broadcast(spark, folder):
    return _model_text(_fit(spark, folder, **BROADCAST))


def kmeans_fit_streamed(spark, folder):
    return _model_text(_fit(spark, folder, **STREAMED))


def kmeans_fit_sampled(spark, folder):
    return _model_text(_fit(spark, folder, max_points_per_centroid=SAMPLED))


def kmeans_restarts(spark, folder):
    return _model_text(_fit(spark, folder, n_init=2))


def kmeans_objective(spark, folder):
    return _fit(spark, folder).select("objective").distinct()


def _assigned(spark, folder, options=ONE) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    model = kmeans.kmeans_fit(rows, FIT_K, "embedding", "vec_id", ONE)
    return kmeans.kmeans_assign(rows, model, "embedding", options, "vec_id")


def assign(spark, folder):
    rows = _assigned(spark, folder)
    return rows.select("vec_id", F.col("cluster").cast("bigint").alias("cluster"), "dist")


def assign_streamed(spark, folder):
    rows = _assigned(spark, folder, KMeansOptions(max_iter=1, scale=SCALE, **STREAMED))
    return rows.select("vec_id", F.col("cluster").cast("bigint").alias("cluster"), "dist")


def cluster_sizes(spark, folder):
    sizes = clusters.cluster_sizes(_assigned(spark, folder), "cluster")
    return sizes.select(F.col("cluster").cast("bigint").alias("cluster"), "n")


def empty_clusters(spark, folder):
    ids = clusters.empty_clusters(table(spark, folder, "supplier"), "s_nationkey", 40)
    return ids.select(F.col("s_nationkey").cast("bigint").alias("cluster"))


def valid_clusters(spark, folder):
    rows = clusters.valid_clusters(table(spark, folder, "customer"), "c_nationkey", 20)
    return rows.select("c_custkey")


def conservation(spark, folder):
    """Rows before and after an assignment."""
    rows = table(spark, folder, "embeddings")
    return clusters.conservation(rows, _assigned(spark, folder), "cluster", FIT_K)


def representatives(spark, folder):
    best = clusters.representatives(
        _assigned(spark, folder), ["cluster"], "dist", ["vec_id"], ["vec_id", "label", "dist"]
    )
    return best.select(
        F.col("cluster").cast("bigint").alias("cluster"), "vec_id",
        F.col("label").cast("bigint").alias("label"), "dist",
    )


def _k2(spark, folder, name, key, method, value, base_k) -> DataFrame:
    counts = clusters.group_counts(table(spark, folder, name), key, method, value, base_k)
    return counts.select(F.col(key).cast("bigint").alias("g"), "n", "k2")


def k2_ratio(spark, folder):
    return _k2(spark, folder, "embeddings", "label", "ratio", 8.0, 2)


def k2_sqrt(spark, folder):
    return _k2(spark, folder, "customer", "c_nationkey", "sqrt", 8.0, 2)


def k2_fixed(spark, folder):
    return _k2(spark, folder, "customer", "c_nationkey", "fixed", 12.9, 2)


def k2_default(spark, folder):
    return _k2(spark, folder, "customer", "c_nationkey", "default", 1.0, 2)


def k2_base(spark, folder):
    """base_k above many group sizes: those groups get one sub-cluster per row."""
    return _k2(spark, folder, "supplier", "s_nationkey", "ratio", 0.0, 5)


# --- two stages ---------------------------------------------------------------------------------


def _stages(spark, folder, options=STAGE) -> hierarchy.Hierarchy:
    return hierarchy.hierarchical_cluster(
        table(spark, folder, "embeddings"),
        HierarchyOptions(K1, "ratio", RATIO, BASE_K, STAGE, options),
        "embedding", "vec_id",
    )


def _detail(df: DataFrame) -> DataFrame:
    return df.select(
        "vec_id",
        *[F.col(c).cast("bigint").alias(c) for c in ("cluster_k1", "CLUSTER_k2")],
        F.col("DISTANCE_k2").cast("double").alias("DISTANCE_k2"),
    )


def stage1(spark, folder):
    rows, _ = hierarchy.stage1(
        table(spark, folder, "embeddings"), K1, "embedding", "vec_id", STAGE
    )
    return rows.select("vec_id", F.col("cluster_k1").cast("bigint").alias("cluster_k1"), "dist")


def stage2_details(spark, folder):
    return _detail(_stages(spark, folder).details)


def stage2_centers(spark, folder):
    return _detail(_stages(spark, folder).centers)


def stage2_centers_broadcast(spark, folder):
    options = KMeansOptions(max_iter=STAGE_ITER, scale=SCALE, **BROADCAST)
    return _detail(_stages(spark, folder, options).centers)


def stage2_details_streamed(spark, folder):
    options = KMeansOptions(max_iter=STAGE_ITER, scale=SCALE, **STREAMED)
    return _detail(_stages(spark, folder, options).details)


def stage2_report(spark, folder):
    report = _stages(spark, folder).report
    return report.withColumn("cluster_k1", F.col("cluster_k1").cast("bigint"))


def representatives_final(spark, folder):
    path = scratch_path(spark, "representatives")
    sinks.write_representatives(_stages(spark, folder).centers, path)
    rows = spark.read.parquet(path)
    return rows.select("vec_id", F.col("label").cast("bigint").alias("label"))


def document_bits(spark, folder) -> DataFrame:
    """Documents normalised, deduplicated over the whole table and fingerprinted."""
    unique = normalize.canonical_dedup(
        table(spark, folder, "documents"), "text", "doc_id", "fold", "doc_id", "global"
    )
    bits = fingerprints.add_fingerprint(unique, "text", FingerprintOptions(n_bits=DOC_BITS))
    return bits.select(
        F.col("doc_id").alias("row_id"), F.col("text").alias("smiles"),
        F.col("doc_id").cast("string").alias("name"), "fp",
    )


def document_representatives(spark, folder):
    """From raw documents to representatives: all steps in a row.

    Texts go as far as their fingerprints; what is stored and clustered is ids and bits.
    """
    bits = materialize(document_bits(spark, folder).select("row_id", "fp"), "fingerprints")
    result = hierarchy.hierarchical_cluster(
        bits, HierarchyOptions(K1, "ratio", RATIO, BASE_K, STAGE, STAGE)
    )
    return result.centers.select(
        "row_id",
        *[F.col(c).cast("bigint").alias(c) for c in ("cluster_k1", "CLUSTER_k2")],
        F.col("DISTANCE_k2").cast("double").alias("DISTANCE_k2"),
    )


# --- sinks --------------------------------------------------------------------------------------


def write_preprocessed(spark, folder):
    path = scratch_path(spark, "preprocessed")
    unique = dedup_global(spark, folder)
    sinks.write_preprocessed(unique, path, "text", "doc_id", "\t")
    schema = "text string, doc_id bigint"
    return spark.read.schema(schema).options(
        sep="\t", header=True, escape='"', multiLine=True
    ).csv(path)


def write_empty(spark, folder):
    """No document normalises to NULL here, so the written table has only its header, read as text."""
    path = scratch_path(spark, "empty")
    docs = normalize.normalize(table(spark, folder, "documents"), "text", "fold")
    failed = docs.filter("canonical is null").select("text", "doc_id")
    sinks.write_preprocessed(failed, path, "text", "doc_id", "\t")
    return spark.read.text(path).distinct()


def export_smi(spark, folder):
    path = scratch_path(spark, "smi")
    sinks.export_smi(table(spark, folder, "part"), path, "p_name", "p_brand", "\t")
    return spark.read.text(path)


def export_smi_header(spark, folder):
    path = scratch_path(spark, "smi")
    sinks.export_smi(table(spark, folder, "customer").coalesce(1), path, "c_name", "c_mktsegment",
                     write_header=True)
    return spark.read.text(path)


def export_csv(spark, folder):
    """Free text with quotes, commas and line breaks survives the round trip."""
    path = scratch_path(spark, "csv")
    sinks.export_csv(table(spark, folder, "documents"), path, ["doc_id", "text", "source"])
    schema = "doc_id bigint, text string, source string"
    return spark.read.schema(schema).options(header=True, escape='"', multiLine=True).csv(path)


def export_csv_clusters(spark, folder):
    path = scratch_path(spark, "csv")
    parts = table(spark, folder, "part")
    sinks.export_csv(parts, path, ["p_partkey", "p_name"], cluster="p_size")
    schema = "p_partkey bigint, p_name string, p_size bigint"
    return spark.read.schema(schema).options(header=True, escape='"').csv(path)


def clusters_roundtrip(spark, folder):
    path = scratch_path(spark, "clusters")
    rows = table(spark, folder, "embeddings").withColumn("cluster_k1", F.col("label"))
    sinks.write_clusters(rows, path)
    return files.read_clusters(spark, path).select(
        "vec_id", F.col("cluster_k1").cast("bigint").alias("cluster_k1"),
        joined(F.transform("embedding", lambda x: F.floor(x.cast("double") * (1 << 24)))).alias("embedding"),
    )


def clusters_pruned(spark, folder):
    path = scratch_path(spark, "clusters")
    rows = table(spark, folder, "embeddings").withColumn("cluster_k1", F.col("label"))
    sinks.write_clusters(rows, path)
    return files.read_clusters(spark, path, cluster=3).select("vec_id")


def write_fingerprints(spark, folder):
    path = scratch_path(spark, "bits")
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("row_id"), F.col("p_name").alias("smiles"),
        F.col("p_brand").alias("name"),
    )
    bits = fingerprints.add_fingerprint(parts, "smiles")
    sinks.write_fingerprints(bits, path, fp_dtype="int16")
    rows = files.read_fingerprints(spark, path)
    return rows.select("row_id", "smiles", "name", joined("fp").alias("fp"))


def recompress(spark, folder):
    path = scratch_path(spark, "orders")
    sinks.recompress(spark, f"{folder}/orders.parquet", path, "gzip", 9)
    rows = spark.read.parquet(path)
    day = F.col("o_orderdate").cast("date").cast("string").alias("o_orderdate")
    return rows.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", day, "o_orderpriority")


def split_parts(spark, folder):
    path = scratch_path(spark, "parts")
    sinks.write_parts(table(spark, folder, "orders").select("o_orderkey"), path, 7, ["o_orderkey"])
    rows = spark.read.parquet(path)
    return rows.select("o_orderkey", F.col("part").cast("bigint").alias("part"))


def ordinals_by_text(spark, folder):
    """Whole-table row numbers by a text column with many ties, told apart by the key."""
    docs = table(spark, folder, "documents").select("doc_id", "lang")
    return ordinals.with_ordinal(docs, ["lang", "doc_id"])


# --- looking into tables ------------------------------------------------------------------------


def profile(spark, folder):
    rows = table(spark, folder, "embeddings")
    return profiles.profile(rows.select("vec_id", "embedding", "label"))


def profile_documents(spark, folder):
    return profiles.profile(table(spark, folder, "documents").drop("text"))


def preview(spark, folder):
    return profiles.preview(table(spark, folder, "documents"), "lang", "doc_id", 10)


def completeness(spark, folder):
    """Nations without a customer file, found from the files themselves."""
    path = scratch_path(spark, "by_nation")
    suppliers = table(spark, folder, "supplier")
    sinks.write_preprocessed(suppliers, path, "s_name", "s_suppkey", source="s_nationkey")
    found = files.find_files(spark, path, "*.csv", None)
    present = found.select(
        F.regexp_extract("path", "s_nationkey=([0-9]+)/", 1).cast("int").alias("n_nationkey")
    )
    missing = profiles.missing_parts(table(spark, folder, "nation"), present, "n_nationkey")
    return missing.select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"))


def completeness_customers(spark, folder):
    expected = table(spark, folder, "customer").select("c_custkey")
    present = table(spark, folder, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return profiles.missing_parts(expected, present, "c_custkey")


def completeness_labels(spark, folder):
    """Documents without a label."""
    return profiles.missing_parts(table(spark, folder, "documents"), table(spark, folder, "labels"), "doc_id")


def to_dense_vectors(spark, folder):
    """The ones of every fingerprint, back to a dense vector."""
    bits = _named_bits(table(spark, folder, "part"), "p_name", 256)
    dense = to_dense(on_bits("fp"), 256)
    return bits.select("key", (dense == F.col("fp")).alias("same"))


def normalize_user_rule(spark, folder):
    """A column function as the rule: the first word, upper case."""
    rule = lambda c: F.upper(F.element_at(F.split(c, " "), 1))
    rows = normalize.normalize(table(spark, folder, "part"), "p_name", rule)
    return rows.select("p_partkey", "canonical")


def kmeans_fit_one(spark, folder):
    """All rows in one cluster: their number and their mean, whatever a sample would be."""
    rows = table(spark, folder, "embeddings")
    return _model_text(kmeans.kmeans_fit(rows, 1, "embedding", "vec_id", FIT)).drop("cluster")


def _plain_fit(spark, folder, spread: int = 1, **changes) -> DataFrame:
    """Every coordinate of every centroid, of a fit without a grid on multiples of 1/1024, some of
    them ``spread`` times as large."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1024) * F.when(F.col("vec_id") % 97 == 0, spread).otherwise(1) / 1024.0)
    rows = table(spark, folder, "embeddings").select("vec_id", whole.alias("v"))
    model = kmeans.kmeans_fit(rows, FIT_K, "v", "vec_id", KMeansOptions(**changes))
    placed = model.select("cluster", "n", F.posexplode("centroid").alias("place", "coordinate"))
    return placed.select(F.col("cluster").cast("bigint").alias("cluster"), "n", F.col("place").cast("bigint").alias("place"), "coordinate")


def kmeans_fixed_point(spark, folder):
    """All default options: the centroids after up to 25 passes."""
    return _plain_fit(spark, folder)


def kmeans_any_spread(spark, folder):
    """Small rows keep their clusters beside rows a million times as long."""
    return _plain_fit(spark, folder, 1 << 20, max_iter=FIT_ITER)


def kmeans_any_spread_broadcast(spark, folder):
    return _plain_fit(spark, folder, 1 << 20, max_iter=FIT_ITER, **BROADCAST)


def kmeans_any_spread_streamed(spark, folder):
    return _plain_fit(spark, folder, 1 << 20, max_iter=FIT_ITER, **STREAMED)


QUERIES = {
    f.__name__: f
    for f in (
        lines_parse, lines_parse_report, lines_valid_report, scan_lines, scan_delimited,
        find_files, find_files_excluded, file_stems,
        normalize_fold, normalize_fragment, normalize_smiles_tokens,
        dedup_per_source, dedup_global, dedup_report,
        fingerprint_qgram, fingerprint_features, fingerprint_token, fingerprint_documents,
        fingerprint_lines, fingerprint_files, fingerprint_union, union_widths, union_compatible, union_tables,
        vector_check, vector_cast, vector_distance,
        kmeans_fit, kmeans_fit_broadcast, kmeans_fit_streamed, kmeans_fit_sampled,
        kmeans_restarts, kmeans_objective,
        assign, assign_streamed, cluster_sizes, empty_clusters, valid_clusters, conservation,
        representatives, k2_ratio, k2_sqrt, k2_fixed, k2_default, k2_base,
        stage1, stage2_details, stage2_centers, stage2_centers_broadcast,
        stage2_details_streamed, stage2_report, representatives_final, document_representatives,
        write_preprocessed, write_empty, export_smi, export_smi_header, export_csv,
        export_csv_clusters, clusters_roundtrip, clusters_pruned, write_fingerprints, recompress,
        split_parts, ordinals_by_text,
        profile, profile_documents, preview, completeness, completeness_customers,
        completeness_labels, to_dense_vectors, normalize_user_rule, kmeans_fit_one, kmeans_fixed_point,
        kmeans_any_spread, kmeans_any_spread_broadcast, kmeans_any_spread_streamed,
    )
}
