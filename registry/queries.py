"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskline import catalog as C
from maskline.operators import audit as A
from maskline.operators import detect as D
from maskline.operators import mapping as M
from maskline.operators import retrieve as R
from maskline.operators.lookup import salted_join
from maskline.operators.known import KNOWN, as_values, attach_known
from maskline.operators.tokenize import restore, round_trip_differences, tokenize
from maskline.plans import jobs as P
from maskline.sources import documents as IO
from maskline.sources import mapping_store as V
from maskline.sources.token_store import TokenStore
from maskline.sources.staging import new_path, stage
from maskline.streaming import jobs as G
from registry import inputs as I

Query = Callable[[SparkSession, str], DataFrame]

LANGS = ("de", "en", "es", "fr")
CROSS = C.detectors(LANGS)
POLISH = C.detectors(["pl"])
POLISH_ALL = C.detectors(["pl"], include_opt_in=True)
ALL = C.detectors(["pl", *LANGS])
CUSTOMER_ID = C.custom_detector(
    "customer_id",
    r"(?<![\p{L}\p{N}_])CID-\d{5,}(?![\p{L}\p{N}_])",
    pii_type="CUSTOMER_ID",
    score=0.85,
    context=["customer", "klient", "sprawa"],
    hint=["=CID-"],
)


def found(findings: DataFrame, *more: str) -> DataFrame:
    """The columns of a finding, offsets as BIGINT."""
    return findings.select(
        *more, "doc_id", "detector", "entity", "pii_type", F.col("start").cast("bigint").alias("start"),
        F.col("end").cast("bigint").alias("end"), "value", "pattern_score", F.round("score", 6).alias("score"),
    )


def one_detector(name: str) -> Query:
    rows = [d for d in POLISH_ALL if d.name == name]

    def query(spark: SparkSession, sf: str) -> DataFrame:
        return found(D.detect(I.notes(spark, sf), rows))

    return query


def cross_detector(name: str) -> Query:
    rows = [d for d in CROSS if d.name == name]

    def query(spark: SparkSession, sf: str) -> DataFrame:
        return found(D.detect(I.documents(spark, sf), rows))

    return query


def entries(mapping: DataFrame) -> DataFrame:
    return mapping.select(*M.MAPPING_COLUMNS)


# --- sources and sinks ---------------------------------------------------------------


def read_documents(spark, sf):
    folder = new_path(spark, "folder")
    named = I.documents(spark, sf).select(F.concat("doc_id", F.lit(".txt")).alias("doc_id"), "text")
    IO.write_folder(named, folder)
    files = IO.read_folder(spark, folder)
    return files.select(F.regexp_extract("doc_id", r"\A(\d+)\.txt\z", 1).cast("bigint").alias("doc_id"), "text")


def read_table(spark, sf):
    path = new_path(spark, "customers-csv")
    source = I.table(spark, sf, "customer")
    source.write.option("header", True).csv(path)
    return IO.read_table(spark, path, "csv", source.schema, header=True)


def write_documents(spark, sf):
    path = new_path(spark, "tokenized")
    IO.write_documents(tokenize(I.documents(spark, sf), CROSS).table, path)
    return IO.read_table(spark, path).select("doc_id", "text")


def mapping_export(spark, sf):
    return V.export_json(tokenize(I.notes(spark, sf), POLISH).mapping, part_size=1000).select(
        "scope", F.col("part").cast("bigint").alias("part"), "mapping_json"
    )


def mapping_import(spark, sf):
    mapping, _ = stage(tokenize(I.notes(spark, sf), POLISH).mapping, "mapping")
    exported, _ = stage(V.export_json(mapping), "mapping-json")
    return entries(V.import_json(exported))


def mapping_vault(spark, sf):
    path = new_path(spark, "vault")
    V.save_to_vault(tokenize(I.notes(spark, sf), POLISH, scope=F.col("doc_id").cast("string")).mapping, path)
    return entries(V.load_from_vault(spark, path))


def write_report(spark, sf):
    path = new_path(spark, "report")
    A.report(D.detect(I.notes(spark, sf), POLISH)).write.json(path)
    schema = "doc_id bigint, entity_type string, start bigint, end bigint, score double, detector string"
    return IO.read_payloads(spark, path, schema)


# --- detector selection --------------------------------------------------------------


def findings_per_detector(spark, sf):
    # Counts need no scores, and so no context.
    found_ = D.detect(I.everything(spark, sf), ALL, key=["source", "lang", "doc_id"], boost=0)
    return D.count_per_detector(found_, "source", "lang")


def detect_opt_in(spark, sf):
    return found(D.detect(I.notes(spark, sf), POLISH_ALL))


def findings_relabelled(spark, sf):
    f = D.detect(I.notes(spark, sf), POLISH_ALL, boost=0)
    return f.groupBy(
        D.entity_of("pii_type").alias("entity"), D.pii_type_of("entity").alias("pii_type")
    ).agg(F.count(F.lit(1)).alias("n"))


def context_override(spark, sf):
    rows = C.with_context(POLISH, {"pl_pesel": ["zgłoszenie", "ewidencyjny"], "pl_nip": []})
    return found(D.detect(I.notes(spark, sf), rows, entities=["PL_PESEL", "PL_NIP"]))


def detect_custom(spark, sf):
    return found(D.detect(I.notes(spark, sf), [*POLISH, CUSTOMER_ID], entities=["CUSTOMER_ID", "EMAIL_ADDRESS"]))


def detect_excluding(spark, sf):
    rows = C.excluding(POLISH, ["EMAIL_ADDRESS", "CREDIT_CARD"])
    return D.count_per_detector(D.detect(I.notes(spark, sf), rows, boost=0))


def tokenize_whitelist(spark, sf):
    return tokenize(
        I.notes(spark, sf), POLISH, entities=["PL_PESEL", "EMAIL_ADDRESS"], others="keep"
    ).table.select("doc_id", "text")


def tokenize_others_masked(spark, sf):
    return tokenize(
        I.notes(spark, sf), POLISH, entities=["PL_PESEL", "EMAIL_ADDRESS"], others="mask"
    ).table.select("doc_id", "text")


def tokenize_others_by_entity(spark, sf):
    """Card numbers keep their last four digits, e-mail addresses become digests, other findings are masked."""
    actions = {
        "CREDIT_CARD": lambda v: F.concat(F.lit("****"), F.substring(v, -4, 4)),
        "EMAIL_ADDRESS": lambda v: F.sha2(F.concat(F.lit("salt:"), v), 256),
    }
    result = tokenize(I.notes(spark, sf), POLISH, entities=["PL_PESEL"], others=actions)
    return result.table.select("doc_id", "text")


def tokenize_threshold(spark, sf):
    return tokenize(I.notes(spark, sf), POLISH_ALL, min_score=0.75).table.select("doc_id", "text")


# --- detection -----------------------------------------------------------------------


def detect_all(spark, sf):
    return found(D.detect(I.everything(spark, sf), ALL, key=["source", "doc_id"]), "source")


def detect_multilingual(spark, sf):
    return found(D.detect(I.derived(spark, sf, I.ROUTED_SQL), ALL))


def detect_copies(spark, sf):
    """The same findings, with every distinct text searched once."""
    return found(D.detect_distinct(I.derived(spark, sf, I.ROUTED_SQL), ALL))


def detect_languages(spark, sf):
    """The same numbers are findings in Polish and none elsewhere; no or another language gets the common detectors."""
    return found(D.detect(I.derived(spark, sf, I.LANGUAGES_SQL), C.detectors(["pl", "en"]), unknown_lang="cross"))


def detect_offsets(spark, sf):
    f = D.detect(I.documents(spark, sf), CROSS).withColumnRenamed("value", "found")
    cut = F.substring("text", F.col("start") + 1, F.col("end") - F.col("start"))
    return f.join(I.documents(spark, sf), "doc_id").select(
        "doc_id", "detector", F.col("start").cast("bigint"), F.col("end").cast("bigint"),
        cut.alias("value"), (cut == F.col("found")).alias("matches"),
    )


def detect_rejected(spark, sf):
    both = D.look_alikes(I.everything(spark, sf), ALL, key=["source", "doc_id"])
    return D.count_outcomes(both)


def context_boost(spark, sf):
    f = D.detect(I.notes(spark, sf), POLISH_ALL)
    return f.groupBy("detector", "pattern_score", F.round("score", 6).alias("score")).agg(
        F.count(F.lit(1)).alias("n")
    )


def score_threshold(spark, sf):
    return found(D.detect(I.notes(spark, sf), POLISH, min_score=0.75))


def entity_filter(spark, sf):
    return found(D.detect(I.notes(spark, sf), POLISH, entities=["IBAN_CODE", "PHONE_NUMBER"]))


def resolve_overlaps(spark, sf):
    return found(D.detect(I.notes(spark, sf), POLISH_ALL, resolve=True))


def findings_sorted(spark, sf):
    return found(D.in_text_order(D.detect(I.documents(spark, sf), CROSS)))


# --- token allocation ----------------------------------------------------------------


def note_values(spark, sf, scope="corpus"):
    f = D.detect(I.notes(spark, sf), POLISH, resolve=True)
    scope = F.lit(scope) if scope == "corpus" else F.col("doc_id").cast("string")
    return f.select(scope.alias("scope"), "pii_type", "value")


def allocate_tokens(spark, sf):
    return M.allocate(note_values(spark, sf)).select("scope", "pii_type", "token", "value")


def allocate_ordinals(spark, sf):
    return entries(M.allocate(note_values(spark, sf), digest_chars=2))


def extend_mapping(spark, sf):
    first = D.detect(I.documents(spark, sf), CROSS).select(F.lit("corpus").alias("scope"), "pii_type", "value")
    mapping, _ = stage(M.allocate(first), "mapping")
    return entries(M.extend(mapping, note_values(spark, sf)))


def preseed_values(spark, sf):
    names = I.derived(spark, sf, I.NAMES_SQL).select(
        F.lit("corpus").alias("scope"), F.lit("PERSON").alias("pii_type"), F.col("name").alias("value")
    )
    return entries(M.allocate(note_values(spark, sf).unionByName(as_values(names))))


def allocate_per_document(spark, sf):
    return entries(M.allocate(note_values(spark, sf, "document")))


def mapping_size(spark, sf):
    return M.mapping_size(M.allocate(note_values(spark, sf)))


def token_consistency(spark, sf):
    result = tokenize(I.notes(spark, sf), POLISH)
    used = salted_join(
        result.spans, result.mapping.drop("ordinal"), ["scope", "pii_type", "value"], spread=["doc_id", "start"]
    )
    # counted where the join put them, and once: what is asked below needs each pair only
    pairs, _ = stage(used.groupBy("scope", "pii_type", "value", "token").agg(F.count(F.lit(1)).alias("n")), "pairs")
    wrong = M.inconsistencies(pairs).count()
    return pairs.groupBy("pii_type").agg(
        F.countDistinct("value").alias("values"),
        F.countDistinct("token").alias("tokens"),
        F.sum("n").alias("uses"),
        F.lit(wrong).cast("bigint").alias("inconsistent"),
    )


# --- substitution --------------------------------------------------------------------


def tokenize_documents(spark, sf):
    return tokenize(I.documents(spark, sf), CROSS).table.select("doc_id", "lang", "text")


def tokenize_notes(spark, sf):
    return tokenize(I.notes(spark, sf), POLISH_ALL).table.select("doc_id", "text")


TYPED = {"name": "PERSON", "email": "EMAIL", "pesel": "PL_PESEL", "iban": "PL_IBAN"}


def tokenize_columns(spark, sf):
    people = I.derived(spark, sf, I.TYPED_SQL)
    return tokenize(people, [], key=["id"], free_text=[], typed=TYPED, lang=F.lit("pl")).table


def mixed_table(spark, sf):
    people = I.derived(spark, sf, I.TYPED_SQL)
    return people, tokenize(people, POLISH, key=["id"], free_text=["notes"], typed=TYPED, lang=F.lit("pl"))


def tokenize_table(spark, sf):
    return mixed_table(spark, sf)[1].table


def case_names(spark, sf):
    return I.derived(spark, sf, I.NAMES_SQL).select(
        "case_id", F.col("name").alias("value"), F.lit("PERSON").alias("pii_type"), "seq"
    )


def replace_known_values(spark, sf):
    listed = attach_known(I.cases(spark, sf), case_names(spark, sf), ["case_id"], spread=["doc_id"])
    return tokenize(listed, [], known=KNOWN).table.select("doc_id", "text")


def known_after(spark, sf):
    """Names are looked for in what the detectors left over."""
    listed = attach_known(I.cases(spark, sf), case_names(spark, sf), ["case_id"], spread=["doc_id"])
    return tokenize(listed, POLISH, known=KNOWN, known_first=False).table.select("doc_id", "text")


def known_long_list(spark, sf):
    """All customers' names as one list for all texts; no row gets the list."""
    names = I.derived(spark, sf, I.ALL_NAMES_SQL).select(F.col("name").alias("value"), F.lit("PERSON").alias("pii_type"), "seq")
    listed = attach_known(I.cases(spark, sf), names, [], spread=["doc_id"])
    return tokenize(listed, [], known=KNOWN).table.select("doc_id", "text")


def tokenize_unkeyed(spark, sf):
    """Keys that are null or repeated."""
    return tokenize(I.derived(spark, sf, I.UNKEYED_SQL), CROSS).table.select("doc_id", "text")


def tokenize_literals(spark, sf):
    """Texts that mention tokens of the mapping they are tokenized with come back as they were."""
    mapping, _ = stage(tokenize(I.documents(spark, sf), CROSS).mapping, "mapping")
    result = tokenize(I.derived(spark, sf, I.LITERALS_SQL), CROSS, mapping=mapping)
    table, _ = stage(result.table, "tokenized")
    grown, _ = stage(result.mapping, "mapping")
    return restore(table, grown, columns=["text"]).select("doc_id", "text")


def tokenize_custom(spark, sf):
    return tokenize(I.notes(spark, sf), [*POLISH, CUSTOMER_ID]).table.select("doc_id", "text")


# --- restore -------------------------------------------------------------------------


def tokenized_notes(spark, sf):
    result = tokenize(I.notes(spark, sf), POLISH)
    table, _ = stage(result.table, "tokenized")
    mapping, _ = stage(result.mapping, "mapping")
    return table, mapping


def restore_documents(spark, sf):
    result = tokenize(I.documents(spark, sf), CROSS)
    table, _ = stage(result.table, "tokenized")
    mapping, _ = stage(result.mapping, "mapping")
    return restore(table, mapping, columns=["text"]).select("doc_id", "lang", "text")


def restore_from_saved(spark, sf):
    table, mapping = tokenized_notes(spark, sf)
    saved, _ = stage(V.export_json(mapping), "mapping-json")
    return restore(table, V.import_json(saved), columns=["text"]).select("doc_id", "text")


def restore_table(spark, sf):
    _, result = mixed_table(spark, sf)
    table, _ = stage(result.table, "tokenized")
    return restore(table, result.mapping, key=["id"])


def restore_selected(spark, sf):
    table, mapping = tokenized_notes(spark, sf)
    chosen = I.derived(spark, sf, I.SUBJECTS_SQL).select("pii_type", "value")
    return restore(
        table, mapping.join(chosen, ["pii_type", "value"], "left_semi"), columns=["text"]
    ).select("doc_id", "text")


def round_trip_check(spark, sf):
    table, mapping = tokenized_notes(spark, sf)
    source = I.notes(spark, sf)
    wrong = round_trip_differences(source, restore(table, mapping, columns=["text"]), ["doc_id"], ["text"])
    return wrong.agg(F.count(F.lit(1)).alias("differences"))


def round_trip_unkeyed(spark, sf):
    """Keys that are null or repeated do not show as differences."""
    source = I.derived(spark, sf, I.UNKEYED_SQL)
    result = tokenize(source, CROSS)
    table, _ = stage(result.table, "tokenized")
    mapping, _ = stage(result.mapping, "mapping")
    wrong = round_trip_differences(source, restore(table, mapping, columns=["text"]), ["doc_id"], ["text"])
    return wrong.agg(F.count(F.lit(1)).alias("differences"))


# --- nested JSON ---------------------------------------------------------------------


def tokenize_json(spark, sf):
    calls = I.tool_calls(spark, sf)
    result = tokenize(calls, POLISH, key=["id"], free_text=["payload"], lang=F.lit("pl"))
    return I.opened(result.table)


def restore_json(spark, sf):
    calls = I.tool_calls(spark, sf)
    result = tokenize(calls, POLISH, key=["id"], free_text=["payload"], lang=F.lit("pl"))
    trace, _ = stage(result.table, "trace")
    return I.opened(restore(trace, result.mapping, key=["id"]))


def tokenize_payloads(spark, sf):
    """JSON text of no declared schema, its keys other ones in each row."""
    return tokenize(
        I.loose_calls(spark, sf), POLISH, key=["id"], free_text=[], json=["payload"], lang=F.lit("pl")
    ).table


def restore_payloads(spark, sf):
    result = tokenize(I.loose_calls(spark, sf), POLISH, key=["id"], free_text=[], json=["payload"], lang=F.lit("pl"))
    trace, _ = stage(result.table, "trace")
    return restore(trace, result.mapping, key=["id"], json=["payload"])


def tokenize_json_numbers(spark, sf):
    events = I.table(spark, sf, "events").select(
        "event_id", F.from_json("props", "struct<k:bigint>").alias("props"), "event_type"
    )
    result = tokenize(events, POLISH, key=["event_id"], free_text=["props", "event_type"], lang=F.lit("pl"))
    return result.table.select("event_id", F.col("props.k").alias("k"), "event_type")


# --- audit ---------------------------------------------------------------------------


def audit_report(spark, sf):
    return A.report(D.detect(I.notes(spark, sf), POLISH, min_score=0.4), preview=True).select(
        "doc_id", "entity_type", F.col("start").cast("bigint"), F.col("end").cast("bigint"), "score",
        "detector", "value_preview",
    )


def audit_summary(spark, sf):
    return A.summary(D.detect(I.everything(spark, sf), ALL, key=["source", "doc_id"], boost=0))


def audit_total(spark, sf):
    return A.total(D.detect(I.everything(spark, sf), ALL, key=["source", "doc_id"], min_score=0.75))


def audit_diff(spark, sf):
    notes = I.notes(spark, sf)
    before = D.detect(notes, C.excluding(POLISH, ["CREDIT_CARD"]))
    after = D.detect(notes, C.with_context(POLISH_ALL, {"pl_pesel": []}))
    columns = ["doc_id", "entity", "start", "end", "score"]
    (before, _), (after, _) = (stage(x.select(*columns), "report") for x in (before, after))
    return A.diff(before, after).select(
        "doc_id", "entity", F.col("start").cast("bigint"), F.col("end").cast("bigint"), "change",
        F.round("score_before", 6).alias("score_before"), F.round("score_after", 6).alias("score_after"),
    )


def audit_rejected(spark, sf):
    return A.rejected(D.look_alikes(I.everything(spark, sf), ALL, key=["source", "doc_id"]))


def audit_overlaps(spark, sf):
    notes = I.notes(spark, sf)
    dropped = A.dropped_overlaps(D.detect(notes, POLISH_ALL), D.detect(notes, POLISH_ALL, resolve=True))
    return D.count_per_detector(dropped)


# --- retrieval -----------------------------------------------------------------------


def questions(spark, sf):
    """Each order's customer asks about the e-mail address in the notes."""
    return I.derived(
        spark,
        sf,
        "SELECT c_custkey AS query_id, 'pl' AS lang, 'Jakie sprawy zgłosił klient ' || "
        "'klient' || cast(c_custkey as string) || '@example.pl' || ' w segmencie ' || c_mktsegment || '?' "
        "AS text FROM customer",
    )


def benchmark_queries(spark, sf):
    return I.table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def bag_of_words(spark, sf):
    tokenized = tokenize(I.documents(spark, sf), CROSS).table
    return R.bag_of_words(tokenized).select("doc_id", "term", "tf")


def cosine_scores(spark, sf):
    scores = R.cosine_scores(benchmark_queries(spark, sf), I.documents(spark, sf))
    return scores.select("query_id", "doc_id", F.round("score", 6).alias("score"))


def retrieve_topk(spark, sf):
    asked, docs = benchmark_queries(spark, sf), I.documents(spark, sf)
    hits = R.top_k(R.leading_scores(asked, docs, 2), 2, queries=asked, docs=docs)
    return hits.select("query_id", F.col("rank").cast("bigint"), "doc_id", F.round("score", 6).alias("score"))


def tokenize_queries(spark, sf):
    mapping, _ = stage(tokenize(I.notes(spark, sf), POLISH).mapping, "mapping")
    return tokenize(
        questions(spark, sf), POLISH, key=["query_id"], mapping=mapping, allocate=False
    ).table.select("query_id", "text")


def build_prompts(spark, sf):
    asked, docs = benchmark_queries(spark, sf), I.documents(spark, sf)
    hits = R.top_k(R.leading_scores(asked, docs, 2), 2, min_score=1e-9)
    return R.build_prompts(hits, asked, docs)


# --- composed jobs -------------------------------------------------------------------


def batch_corpus(spark, sf):
    job = P.batch(I.notes(spark, sf), POLISH)
    wrong = job.differences.agg(F.count(F.lit(1)).alias("differences")).first()[0]
    return job.documents.select("doc_id", "text", F.lit(wrong).cast("bigint").alias("differences"))


def retrieval_with_redaction(spark, sf):
    docs = I.table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text", F.lit("en").alias("lang"))
    job = P.retrieval(I.documents(spark, sf), docs.withColumnRenamed("doc_id", "query_id"), CROSS, k=2, min_score=1e-9)
    replies = job.prompts.select("query_id", F.col("prompt").alias("text"))
    staged, _ = stage(replies, "replies")
    return P.answers(staged, job.mapping)


def subject_access(spark, sf):
    return P.deliver_to_subjects(
        I.cases(spark, sf), I.derived(spark, sf, I.SUBJECTS_SQL), I.derived(spark, sf, I.NAMES_SQL), POLISH
    ).table.select("case_id", "doc_id", "text")


def subject_access_artifacts(spark, sf):
    cases = I.cases(spark, sf)
    return P.subject_access_artifacts(cases, subject_access(spark, sf))


def customer_files(spark, sf):
    job = P.customer_files(I.notes(spark, sf))
    wrong = job.differences.agg(F.count(F.lit(1)).alias("n")).first()[0]
    return job.refused.select("detector", "n", "n_values", F.lit(wrong).cast("bigint").alias("differences"))


# --- streams -------------------------------------------------------------------------


def document_stream(spark, sf, source=None):
    """The documents, or the files of `source`, as a stream; the table may be one file or a folder of them."""
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    if source is None:
        # a pattern: Spark does not take a single file by its plain name as a stream
        return spark.readStream.schema(schema).parquet(f"{sf}/documents[.]parquet")
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(source)


def stream_detect(spark, sf):
    out = new_path(spark, "stream-findings")
    G.detect_stream(document_stream(spark, sf), CROSS, out, new_path(spark, "checkpoint")).awaitTermination()
    schema = D.detect(I.documents(spark, sf), CROSS).schema
    return found(spark.read.schema(schema).parquet(out))


def _tokenized_stream(spark, sf):
    store, out = new_path(spark, "stream-mapping"), new_path(spark, "stream-documents")
    G.tokenize_stream(
        document_stream(spark, sf), CROSS, store, out, new_path(spark, "checkpoint")
    ).awaitTermination()
    return store, out


def stream_tokenize(spark, sf):
    _, out = _tokenized_stream(spark, sf)
    return spark.read.parquet(out).select("doc_id", "lang", "text")


def stream_restore(spark, sf):
    store, out = _tokenized_stream(spark, sf)
    restored = new_path(spark, "stream-restored")
    G.restore_stream(
        document_stream(spark, sf, out), store, restored, new_path(spark, "checkpoint")
    ).awaitTermination()
    return spark.read.parquet(restored).select("doc_id", "lang", "text")


def stream_batches(spark, sf):
    """A stream in several batches whose mapping grows, is merged into buckets and restores every text."""
    source, store, out = (new_path(spark, x) for x in ("stream-source", "stream-mapping", "stream-documents"))
    docs = I.documents(spark, sf)
    docs.repartition(4, "doc_id").write.parquet(source)
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(source)
    G.tokenize_stream(stream, CROSS, store, out, new_path(spark, "checkpoint")).awaitTermination()
    kept = TokenStore(spark, store)
    kept.compact()
    return restore(spark.read.parquet(out).select("doc_id", "lang", "text"), kept, columns=["text"])


def stream_literals(spark, sf):
    """A stream of texts that mention tokens the stream itself hands out."""
    texts, _ = stage(I.derived(spark, sf, I.LITERALS_SQL), "literals")
    source, store, out = texts.inputFiles()[0].rsplit("/", 1)[0], new_path(spark, "stream-mapping"), new_path(spark, "out")
    stream = spark.readStream.schema(texts.schema).parquet(source)
    G.tokenize_stream(stream, CROSS, store, out, new_path(spark, "checkpoint")).awaitTermination()
    back = new_path(spark, "stream-restored")
    tokens = spark.readStream.schema(texts.schema).parquet(out)
    G.restore_stream(tokens, store, back, new_path(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(back).select("doc_id", "text")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        read_documents, read_table, write_documents, mapping_export, mapping_import, mapping_vault, write_report,
        findings_per_detector, detect_opt_in, findings_relabelled, context_override, detect_custom,
        detect_excluding, tokenize_whitelist, tokenize_others_masked, tokenize_others_by_entity, tokenize_threshold, detect_languages, known_after,
        tokenize_unkeyed, tokenize_literals, stream_literals, detect_all, detect_multilingual, detect_offsets, detect_rejected,
        context_boost, score_threshold, entity_filter, resolve_overlaps, findings_sorted, allocate_tokens,
        allocate_ordinals, extend_mapping, preseed_values, allocate_per_document, mapping_size, token_consistency,
        tokenize_documents, tokenize_notes, tokenize_columns, tokenize_table, replace_known_values, tokenize_custom,
        restore_documents, restore_from_saved, restore_table, restore_selected, round_trip_check, tokenize_json,
        restore_json, tokenize_payloads, restore_payloads, tokenize_json_numbers, audit_report, audit_summary, audit_total, audit_diff, audit_rejected,
        audit_overlaps, bag_of_words, cosine_scores, retrieve_topk, tokenize_queries, build_prompts, batch_corpus,
        retrieval_with_redaction, subject_access, subject_access_artifacts, customer_files, stream_detect,
        stream_tokenize, stream_restore, stream_batches, detect_copies, known_long_list, round_trip_unkeyed,
    )
}
QUERIES |= {
    f"detect_{short}": one_detector(f"pl_{short}")
    for short in ("pesel", "nip", "regon", "id_card", "passport", "iban", "phone", "krs", "postal_code")
}
QUERIES |= {f"detect_{name}": cross_detector(name) for name in ("email", "credit_card")}
