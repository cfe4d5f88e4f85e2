"""Label exchange as tables: requests out, responses in, every slot answered once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from callsheet import dims
from callsheet.functions import phones
from callsheet.functions.stages import computed
from callsheet.functions.text import json_block
from callsheet.operators.paging import positions

ITEM = "struct<number:string,type:string,classification:string>"
ENRICHED = ("struct<extracted_numbers:array<struct<number:string,type:string,classification:string>>,"
            "additional_info:array<struct<info_type:string,value:string,associated_number:string,"
            "source_context:string,confidence:double>>,homepage_summary:string,"
            "overall_confidence:double,processing_notes:array<string>,raw_source_text_snippet:string>")


def request_slots(cands: DataFrame, site: str, order: list, *, max_chunks: int | None, chunk: int = 10) -> DataFrame:
    """Number the candidates of a site into request slots. Given ``max_chunks``, what
    exceeds ``chunk * max_chunks`` is not asked for (the request limit of a site; see
    ``not_requested``): the limit then sits on its window, and tasks pass on no more. Without
    one, places come from sorted ranges, so that no task holds a whole site."""
    if max_chunks is None:
        slots = positions(cands, [site], order, "_n")
    else:
        w = Window.partitionBy(site).orderBy(*order)
        slots = cands.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= chunk * max_chunks).withColumn("_n", F.col("_n") - 1)
    return (slots.withColumn("chunk", F.floor(F.col("_n") / chunk).cast("int"))
            .withColumn("request_id", F.concat_ws("#", F.col(site), F.col("chunk")))
            .withColumn("pos", F.pmod("_n", F.lit(chunk)).cast("int")).drop("_n"))


def not_requested(cands: DataFrame, site: str, order: list, *, max_chunks: int, chunk: int = 10) -> DataFrame:
    """The candidates beyond a site's request limit, with their place in its order."""
    return positions(cands, [site], order, "place").filter(F.col("place") >= chunk * max_chunks)


def render_requests(slots: DataFrame, template: str = dims.PROMPT_PLACEHOLDER) -> DataFrame:
    """One prompt per request; a request holds at most one chunk of slots."""
    fields = ["number", "snippet", "source_url", "company"]
    body = F.to_json(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", *fields))),
        lambda s: F.struct(*[s[f].alias(f) for f in fields])))
    return slots.groupBy("request_id").agg(
        F.count(F.lit(1)).cast("int").alias("n_items"),
        F.replace(F.lit(template), F.lit(dims.PROMPT_PLACEHOLDER), body).alias("prompt"))


def rule_label(snippet: Column, page_type: Column) -> tuple[Column, Column]:
    """(type, classification) by key words, for runs without an outside labeler."""
    rules = [
        (r"(?i)\bfax", "Fax", "Low Relevance"),
        (r"(?i)\b(?:mobil|handy)", "Mobile", "Low Relevance"),
        (r"(?i)\b(?:support|hotline|helpdesk)", "Support Hotline", "Support"),
        (r"(?i)\b(?:sales|vertrieb)", "Sales", "Secondary"),
        (r"(?i)\b(?:zentrale|headquarter)", "Headquarters", "Primary"),
    ]
    kind = cls = None
    for pattern, t, c in rules:
        hit = snippet.rlike(pattern)
        kind = F.when(hit, F.lit(t)) if kind is None else kind.when(hit, F.lit(t))
        cls = F.when(hit, F.lit(c)) if cls is None else cls.when(hit, F.lit(c))
    front = page_type.isin("contact", "imprint", "homepage")
    return (kind.otherwise(F.lit("Main Line")),
            cls.when(front, F.lit("Primary")).otherwise(F.lit("Secondary")))


def rule_labelled(cands: DataFrame) -> DataFrame:
    """Candidates with the rule's labels as columns: what ``reconcile`` makes of
    ``rule_labeler``'s answers, without request slots or answer texts."""
    kind, cls = rule_label(F.col("snippet"), F.col("page_type"))
    return cands.select("*", F.col("number").alias("asked_number"), kind.alias("type"),
                        cls.alias("classification"), F.lit(0).alias("answered_by"))


def rule_labeler(slots: DataFrame) -> DataFrame:
    """The rule as an outside labeler: slots to a response table of fenced JSON."""
    kind, cls = rule_label(F.col("snippet"), F.col("page_type"))
    item = F.struct("pos", "number", kind.alias("type"), cls.alias("classification"))
    body = F.to_json(F.struct(F.transform(
        F.array_sort(F.collect_list(item)),
        lambda s: F.struct(s["number"].alias("number"), s["type"].alias("type"),
                           s["classification"].alias("classification"))).alias("extracted_numbers")))
    return slots.groupBy("request_id").agg(
        F.concat(F.lit("```json\n"), body, F.lit("\n```")).alias("raw_text"),
        F.sum(F.length("snippet")).alias("prompt_tokens"),
        F.count(F.lit(1)).alias("completion_tokens"),
    ).select("request_id", F.lit(0).alias("attempt"), "raw_text", "prompt_tokens",
             "completion_tokens",
             (F.col("prompt_tokens") + F.col("completion_tokens")).alias("total_tokens"))


def parse_responses(responses: DataFrame) -> DataFrame:
    """Adds ``block`` (the JSON text), ``items`` and ``fault`` (NULL when usable). The block
    is parsed once, as a variant; items are read from that."""
    with_block = computed(responses, block=json_block(F.col("raw_text")))
    read = computed(with_block, _json=F.try_parse_json("block"))
    parsed = computed(read, items=F.try_variant_get("_json", "$.extracted_numbers", f"array<{ITEM}>"))
    complete = F.forall("items", lambda x: x["number"].isNotNull() & x["type"].isNotNull()
                        & x["classification"].isNotNull())
    fault = (F.when(F.coalesce("raw_text", F.lit("")) == "", F.lit("Error_ChunkEmptyResponse"))
             .when(F.col("block").isNull(), F.lit("Error_ChunkNoJsonBlock"))
             .when(F.col("_json").isNull(),
                   F.lit("Error_ChunkJsonParseValidate_JSONDecodeError"))
             .when(F.col("block").startswith("["), F.lit("Error_ChunkUnexpected_TypeError"))
             .when(F.col("items").isNull() | ~complete,
                   F.lit("Error_ChunkJsonParseValidate_ValidationError")))
    return computed(parsed, fault=fault).drop("_json")


def reconcile(slots: DataFrame, responses: DataFrame, max_retries: int = 1) -> DataFrame:
    """Exactly one labelled item per slot.

    Items match slots by position; a differing number sends the slot to the next
    attempt, whose response lists only the open slots in order. What stays open
    after the last attempt becomes an error item with the original number."""
    parsed = parse_responses(responses).select("request_id", "attempt", "items", "fault")
    base = [c for c in slots.columns]
    sizes = slots.groupBy("request_id").agg(F.count(F.lit(1)).alias("_n"))
    first = parsed.filter(F.col("attempt") == 0).drop("attempt").join(sizes, "request_id", "right")
    first = first.withColumn(
        "fault", F.when(F.col("items").isNull() & F.col("fault").isNull(), F.lit("Error_NotProcessedInChunk"))
        .when(F.col("fault").isNotNull(), F.col("fault"))
        .when(F.size("items") != F.col("_n"), F.lit("Error_LLMItemCountMismatch"))).drop("_n")
    at = F.try_element_at("items", F.col("pos") + 1)
    state = slots.join(first, "request_id").withColumn("_item", F.when(F.col("fault").isNull(), at))
    matched = F.col("_item.number") == F.col("number")
    state = state.select(
        *base, "fault", F.when(matched, F.col("_item")).alias("answer"),
        F.when(matched, F.lit(0)).alias("answered_by"))
    for attempt in range(1, max_retries + 1):
        is_open = F.col("fault").isNull() & F.col("answer").isNull()
        w = Window.partitionBy("request_id", is_open).orderBy("pos")
        whole = Window.partitionBy("request_id", is_open)
        again = parsed.filter((F.col("attempt") == attempt) & F.col("fault").isNull()).select(
            "request_id", F.col("items").alias("_again"))
        state = (state.withColumn("_open", is_open)
                 .withColumn("_k", F.row_number().over(w))
                 .withColumn("_of", F.count(F.lit(1)).over(whole))
                 .join(again, "request_id", "left"))
        cand = F.when(F.col("_open") & (F.size("_again") == F.col("_of")),
                      F.try_element_at("_again", F.col("_k")))
        state = state.withColumn("_cand", cand)
        ok = F.col("_cand.number") == F.col("number")
        state = state.select(
            *base, "fault", F.coalesce("answer", F.when(ok, F.col("_cand"))).alias("answer"),
            F.coalesce("answered_by", F.when(ok, F.lit(attempt))).alias("answered_by"))
    error = F.coalesce("fault", F.when(F.col("answer").isNull(),
                                       F.lit("Error_PersistentMismatchAfterRetries")))
    kept = [c for c in base if c not in ("number",)]
    final = state.select(
        *kept, F.col("number").alias("asked_number"), error.alias("error"), "answer", "answered_by")
    done = computed(
        final,
        number=F.when(F.col("error").isNull(), phones.e164_any(F.col("answer.number"))
                      ).otherwise(F.col("asked_number")),
        type=F.coalesce("error", F.col("answer.type")),
        classification=F.when(F.col("error").isNull(), F.col("answer.classification")
                              ).otherwise(F.lit("Non-Business")))
    return done.select(*kept, "asked_number", "number", "type", "classification", "answered_by")


def open_slots(slots: DataFrame, labelled: DataFrame) -> DataFrame:
    """Slots a further attempt has to ask again."""
    solved = labelled.filter(~F.col("type").startswith("Error_")).select("request_id", "pos")
    return slots.join(solved, ["request_id", "pos"], "left_anti")


def token_totals(responses: DataFrame, *by: str) -> DataFrame:
    cols = ["prompt_tokens", "completion_tokens", "total_tokens"]
    return responses.groupBy(*by).agg(*[F.sum(c).alias(c) for c in cols],
                                      F.count(F.lit(1)).alias("calls"))


def item_counts(labelled: DataFrame, *by: str) -> DataFrame:
    bad = F.col("type").startswith("Error_")
    return labelled.groupBy(*by).agg(F.count_if(~bad).alias("success_items"),
                                     F.count_if(bad).alias("error_items"))


def enriched_items(responses: DataFrame) -> DataFrame:
    """Numbers of an enriched response with the details that name them;
    confidences outside [0, 1] make the detail invalid."""
    doc = computed(responses, doc=F.from_json(json_block(F.col("raw_text")), ENRICHED))
    numbers = doc.select("request_id", "doc", F.posexplode("doc.extracted_numbers").alias("pos", "n"))
    info = F.filter("doc.additional_info", lambda a: (a["associated_number"] == F.col("n.number"))
                    & a["confidence"].between(0.0, 1.0))
    rows = numbers.select("request_id", "pos", "n",
                          F.col("doc.overall_confidence").alias("overall_confidence"),
                          F.explode_outer(info).alias("a"))
    return rows.select(
        "request_id", "pos", F.col("n.number").alias("number"), F.col("n.type").alias("type"),
        F.col("n.classification").alias("classification"), F.col("a.info_type").alias("info_type"),
        F.col("a.value").alias("value"), F.col("a.confidence").alias("confidence"),
        "overall_confidence")
