"""The stages of a corpus run, over a table store: acquire, train, classify, scope, reverse, names, review, label, export.

Tables: ``<run>`` (what a run found), ``<run>_reverse``, ``classified`` (all curated rows), ``embeddings``,
``labelled``.  Every stage skips what is there already, so a stage that is repeated adds nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.pipeline import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nulls import holds
from ..functions.schema import add_columns
from ..functions.text import joined_text, stamp, strip_markup, too_long
from ..operators import classify as ml
from ..operators import curate, kernel, labels, names, review, search, splits, verdicts
from ..sources import connectors, files
from ..sources.connectors import BatchClient
from ..sources.store import TableStore
from ..streaming.embeddings import embed_in_batches
from . import prompts
from .pipeline import submitted

VERSION = ["family_id", "jurisdiction", "priority_year"]
PREDICTIONS = ["truncated", "proba_scope", "pred_scope", "threshold_scope", "proba_pillar", "pred_pillar", "pred_combined", "date_ML"]
VERDICTS = ["scope_LLM", "confidence_LLM", "plant_based_LLM", "fermentation_LLM", "cultivated_LLM", "cross_cutting_LLM", "status_LLM", "stop_reason_LLM", "pillar_LLM", "date_LLM"]


@dataclass
class Corpus:
    """What distinguishes one corpus from another."""

    store: TableStore
    models: str
    families: bool = True  # patents come in families and versions, publications one by one
    queries: list[str] = field(default_factory=list)
    codes: list[str] = field(default_factory=list)
    allowed_codes: list[str] = field(default_factory=list)
    code_column: str = "cpc"
    year: str = "publication_year"
    years: tuple[int, int] = (1900, 2100)
    kind: str | None = None  # of publications, only those of this type
    load_encoder: Callable[[], ml.Encoder] = ml.hash_encoder
    max_fn: float = 0.01
    test_size: float | None = None  # the threshold from so large a test set; None: from out-of-fold scores
    scope_c: float | None = None  # None: 100 with a kernel, 0.1 without
    pillar_c: float | None = None  # None: 1000 with a kernel, 0.1 without
    with_kernel: bool | None = None  # calibrated kernel machines or logistic regression; None: machines for families
    gamma: float = 0.01
    embed_rows: int = 100_000  # of a batch, after which embeddings are safe
    landmarks: int = 512
    label_types: tuple[labels.LabelType, ...] = labels.PATENT_LABELS
    model: str = "any-model"
    prompts: dict[str, str] = field(default_factory=dict)
    prompt_folder: str | None = None  # of files such as scope.txt, category.txt and category.PB.txt
    batches: str | None = None  # folder for what has been submitted, so that a repeated stage waits for it; None: beside the tables

    @property
    def spark(self) -> SparkSession:
        return self.store.spark

    def prompt(self, name: str) -> str:
        """The instruction of a request type: given, from its file, that of the type without its pillar, or the default."""
        general = name.split(".")[0]
        for n in dict.fromkeys((name, general)):
            if n in self.prompts:
                return self.prompts[n]
            if self.prompt_folder and (text := files.read_text(f"{self.prompt_folder}/{n}.txt")):
                return text.strip()
        text = prompts.default(general)
        if not text:
            raise ValueError(f"no prompt for {name}")
        return text

    @property
    def batch_folder(self) -> str:
        return self.batches or f"{self.store.root}/_batches"

    @property
    def kernels(self) -> bool:
        return self.families if self.with_kernel is None else self.with_kernel

    @property
    def group(self) -> str:
        return "family_id" if self.families else "id"


def _clean(c: Corpus, found: DataFrame) -> DataFrame:
    rows = curate.latest_versions(found, VERSION, [c.year, "kind"]) if c.families else found
    if c.kind:
        rows = rows.where(F.col("type") == c.kind)
    rows = rows.withColumn("abstract", strip_markup("abstract")).withColumn("date_dimensions", stamp())
    return rows.where(search.code_or_none(c.code_column, c.allowed_codes)) if c.allowed_codes else rows


def _enter(c: Corpus, rows: DataFrame) -> DataFrame:
    """Rows that are new to the classified table; stored versions that they supersede are deleted."""
    if not c.store.exists("classified"):
        return rows
    stored = c.store.read("classified")
    rows = curate.unseen(rows, stored)
    if c.families:
        staying, rows = curate.supersede(stored, rows, VERSION, c.year)
        c.store.delete("classified", stored.join(staying.select("id"), "id", "left_anti").select("id"), "id")
    return rows


def acquire(c: Corpus, corpus: DataFrame, run: str) -> None:
    """Search, keep each id once, clean, leave out what is known, and store the run's table."""
    parts = [connectors.by_phrases(corpus, [q], ("title", "abstract"), c.year, *c.years) for q in c.queries]
    if c.codes:
        parts.append(connectors.by_codes(corpus, c.codes, c.code_column, c.year, *c.years))
    c.store.replace(run, _clean(c, connectors.union_results(*parts)))
    c.store.replace(run, _enter(c, c.store.read(run)))


def train(c: Corpus, training: DataFrame) -> float:
    """Embed what is new, fit both models on everything, and choose the threshold from out-of-fold scores."""
    text = joined_text("title", "abstract")
    _embed(c, "training_embeddings", training, text, "train")
    rows = training.drop("embeddings").join(c.store.read("training_embeddings"), "id")
    rows = rows.withColumn("scope", F.when(holds(F.col("scope") == "in"), "in").otherwise("out"))
    fit_rows, test_rows = rows, None
    if c.test_size is not None:
        marked = splits.split(rows, "id", c.test_size, "scope")
        fit_rows, test_rows = marked.where("not is_test"), marked.where("is_test")
    scores = (_train_kernels if c.kernels else _train_logistic)(c, fit_rows, test_rows)
    threshold = ml.fn_threshold(scores, max_fn=c.max_fn).first()["threshold"]
    if threshold is None:
        raise ValueError("no threshold keeps false negatives below the bound")
    pillars = rows.withColumn("pillar", F.coalesce("pillar", F.lit("NA"))) if c.families else rows.where(F.col("pillar").isNotNull())
    if c.kernels:
        kernel.fit(pillars, "pillar", c=c.pillar_c or 1000.0, gamma=c.gamma, size=c.landmarks)[0].save(c.spark, f"{c.models}/pillar")
    else:
        ml.pillar_model(ml.features(pillars), c.pillar_c or 0.1, missing=None).write().overwrite().save(f"{c.models}/pillar")
    files.save_threshold(c.spark, f"{c.models}/threshold", threshold)
    return threshold


def _train_kernels(c: Corpus, rows: DataFrame, test: DataFrame | None) -> DataFrame:
    """Save the scope machines; label and proba of rows that they have not seen."""
    model, dealt = kernel.fit(rows, "scope", c=c.scope_c or 100.0, gamma=c.gamma, size=c.landmarks, cross_validate=test is None)
    model.final().save(c.spark, f"{c.models}/scope")
    scored = model.transform(dealt, outer="outer") if test is None else model.transform(test.select("id", "embeddings", F.col("scope").alias("name")))
    return scored.select("id", (F.col("name") == "in").cast("double").alias("label"), F.col("probabilities")[model.names.index("in")].alias("proba"))


def _train_logistic(c: Corpus, rows: DataFrame, test: DataFrame | None) -> DataFrame:
    """The same with logistic regression."""
    rows, test = (None if x is None else ml.features(x.withColumn("label", (F.col("scope") == "in").cast("double"))) for x in (rows, test))
    fit = lambda part: ml.logistic(part, c.scope_c or 0.1)
    model = fit(rows)
    model.write().overwrite().save(f"{c.models}/scope")
    return ml.cross_validated(rows, fit) if test is None else model.transform(test).select("id", "label", vector_to_array("probability")[1].alias("proba"))


def _embed(c: Corpus, table: str, rows: DataFrame, text: Column, run: str) -> None:
    """Embeddings of rows that have none, batch by batch; a repeated stage goes on behind the last batch."""
    embed_in_batches(c.store, table, rows, text, c.load_encoder, f"{c.store.root}/_work/{table}", c.embed_rows, run)
    # whatever a run that had its list of rows before left out, as when the rows have changed since
    c.store.append(table, ml.embed_new(rows, c.store.read(table), text, c.load_encoder), f"embed-{run}-rest-{uuid.uuid4().hex}")


def _predict(c: Corpus, rows: DataFrame) -> DataFrame:
    """Predictions of rows with embeddings."""
    threshold = files.load_threshold(c.spark, f"{c.models}/threshold")
    if c.kernels:
        scope = kernel.CalibratedMachines.load(c.spark, f"{c.models}/scope")
        scored = scope.transform(rows, output="__p").withColumn("proba_scope", F.col("__p")[scope.names.index("in")]).drop("__p")
    else:
        scored = LogisticRegressionModel.load(f"{c.models}/scope").transform(ml.features(rows))
        scored = scored.withColumn("proba_scope", vector_to_array("probability")[1]).drop("probability", "rawPrediction", "prediction")
    scored = scored.withColumns({"threshold_scope": F.lit(threshold), "pred_scope": (F.col("proba_scope") >= threshold).cast("int")})
    if c.kernels:
        out = kernel.CalibratedMachines.load(c.spark, f"{c.models}/pillar").best(scored, probability="proba_pillar", name="pred_pillar")
    else:
        out = ml.predict_pillar(PipelineModel.load(f"{c.models}/pillar"), scored).drop("features")
    return out.withColumns({"pred_combined": ml.combine(), "date_ML": stamp(), "truncated": too_long(joined_text("title", "abstract"))})


def classify(c: Corpus, run: str) -> None:
    """Known groups take their stored decision; of new ones a representative is embedded and classified."""
    rows = c.store.read(run).drop(*PREDICTIONS)
    known = None
    if c.store.exists("classified"):
        known = c.store.read("classified").where(F.col(c.group).isNotNull())
        marked = curate.split_known(rows, known, c.group)
        old, new = marked.where("is_known").drop("is_known"), marked.where("not is_known").drop("is_known")
    else:
        old, new = None, rows
    reps = curate.representatives(new, [c.group], year=c.year) if c.families else new
    _embed(c, "embeddings", reps, joined_text("title", "abstract"), run)
    decided = _predict(c, reps.join(c.store.read("embeddings"), "id")).select("id", c.group, *PREDICTIONS) if c.families else _predict(c, reps.join(c.store.read("embeddings"), "id")).select("id", *PREDICTIONS)
    done = curate.propagate(new, decided.drop("id") if c.families else decided, c.group, PREDICTIONS)
    if old is not None:
        before = known.withColumn("pred_combined", F.when(F.col("pred_combined") == "in", 1).otherwise(0))
        have = add_columns(before, {p: "string" for p in PREDICTIONS})
        done = done.unionByName(curate.propagate(old, have, c.group, PREDICTIONS, [F.desc_nulls_last("date_ML"), F.asc("id")]), allowMissingColumns=True)
    c.store.replace(run, done)
    out = c.store.read(run).withColumn("pred_combined", ml.in_out("pred_combined"))
    if c.store.exists("classified"):
        out = curate.unseen(out, c.store.read("classified"))
    c.store.append_or_create("classified", out)


def scope(c: Corpus, run: str, client: BatchClient, poll: float = 600) -> None:
    """Ask about a representative of each positive group; the verdict goes to the whole group."""
    rows = c.store.read(run).where(F.col("pred_combined") == 1)
    reps = curate.representatives(rows, [c.group], year=c.year) if c.families else rows
    batch, completed = submitted(c.batch_folder, f"scope-{run}", client, verdicts.requests(reps, verdicts.scope_tool(), c.model, 512, c.prompt("scope")), poll)
    found = verdicts.parse_scope(client.results(c.spark, batch)).withColumn("date_LLM", stamp())
    keyed = reps.select("id", *([c.group] if c.families else [])).join(found, "id")
    source = keyed.drop("id") if c.families else keyed
    for table in (run, "classified"):
        c.store.update(table, source.where(F.col(c.group).isNotNull()), c.group, VERDICTS)
    completed()


def reverse_families(c: Corpus, corpus: DataFrame, run: str) -> None:
    """Members of positive families that the search did not find; they inherit their family's decision."""
    positive = c.store.read(run).where((F.col("pred_combined") == 1) & F.col("family_id").isNotNull())
    rows = _enter(c, _clean(c, connectors.by_keys(corpus, positive, "family_id", c.year, *c.years)))
    columns = [x for x in (*PREDICTIONS, *VERDICTS) if x in positive.columns]
    rows = curate.propagate(rows, positive, "family_id", columns, [F.asc("id")])
    c.store.replace(f"{run}_reverse", rows)
    c.store.append("classified", c.store.read(f"{run}_reverse").withColumn("pred_combined", ml.in_out("pred_combined")))


def reverse_researchers(c: Corpus, corpus: DataFrame, run: str, top: int = 500) -> None:
    """Publications of the researchers who wrote most of the positive ones."""
    positive = c.store.read(run).where(F.col("pred_combined") == 1)
    people = curate.top_keys(connectors.researcher_counts(corpus, positive), ["id", "first_name", "last_name"], "count", top)
    found = connectors.by_researchers(corpus, people, c.year, *c.years)
    c.store.replace(f"{run}_reverse", _enter(c, _clean(c, found)))


def clean_names(c: Corpus, known: DataFrame, companies: DataFrame, column: str = "assignee_names", output: str = "assignee_names_cleaned") -> None:
    """Names by the map of variants, then by the nearest company; lists keep their order."""
    rows = c.store.read("classified").select("id", column)
    mapped = names.map_lists(rows, column, known, "names")
    flat = mapped.select("id", F.posexplode("names").alias("at", "name"))
    best = names.nearest_company(flat, companies)
    lists = flat.join(best, "name", "left").groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", F.coalesce("match", "name").alias("match")))), lambda x: x["match"]).alias("found"))
    out = mapped.join(lists, "id", "left").select("id", F.when(F.col("names").isNotNull(), F.coalesce("found", F.array().cast("array<string>"))).alias(output))
    c.store.update("classified", out, "id", [output])


def company_files(spark: SparkSession, variants: str, database: str) -> tuple[DataFrame, DataFrame]:
    """The map of variants and the list of companies, from the CSV files of both.

    Companies are the clean names of the first file and the names of the second, each where it is first.
    """
    known = names.positioned(files.read_csv(spark, variants, files.header(spark, variants))).select(F.col("Name").alias("name"), F.col("Cleaned-up Name").alias("clean"), F.col("position").alias("ordinal"))
    listed = names.positioned(files.read_csv(spark, database, files.header(spark, database))).select("Company", "position")
    return known, names.ordered_union((known, "clean", "ordinal"), (listed, "Company", "position"))


def review_rows(c: Corpus, path: str, reviewer: str = "auto") -> None:
    """Decide by the rules; what they leave open goes to a CSV file for people."""
    open_rows = c.store.read("classified")
    if "scope_curated" in open_rows.columns:
        open_rows = open_rows.where(F.col("scope_curated").isNull())
    decided = (review.review_patents if c.families else review.review_publications)(open_rows).withColumns({"date_review": stamp(), "reviewer": F.lit(reviewer)})
    manual, rest = review.split_for_review(decided)
    plain = [x.name for x in manual.schema if x.dataType.typeName() not in ("array", "struct", "map")]
    files.write_csv(manual.select(*plain), path, one_file=True)
    c.store.update("classified", rest, "id", ["scope_curated", "pillar_curated", "date_review", "reviewer"])


def merge_reviewed(c: Corpus, path: str) -> None:
    """Take people's decisions back; ids that are not in the table are ignored."""
    reviewed = files.read_csv(c.spark, path, "id string, scope_curated string, pillar_curated string, date_review string, reviewer string")
    c.store.update("classified", curate.first_of_each(reviewed, ["id"], [F.desc_nulls_last("date_review")]), "id", ["scope_curated", "pillar_curated", "date_review", "reviewer"])


def label(c: Corpus, client: BatchClient, poll: float = 300) -> None:
    """Every label type in turn: automatic values, then one request per family and pillar."""
    for kind in c.label_types:
        columns = [f"primary_{kind.name}_LLM", f"secondary_{kind.name}_LLM", f"{kind.name}_status_LLM", f"{kind.name}_stop_reason_LLM"]
        c.store.add_columns("classified", dict.fromkeys([*columns, "date_labelled"], "string"))
        rows = c.store.read("classified")
        if "family_id" not in rows.columns:
            rows = rows.withColumn("family_id", F.lit(None).cast("string"))
        for need in ("jurisdiction", "publication_year"):
            rows = rows if need in rows.columns else rows.withColumn(need, F.lit(None).cast("string"))
        rows = labels.eligible(rows, kind)
        if kind.only_pillars:
            auto = labels.automatic(rows, kind).withColumn("date_labelled", stamp())
            c.store.update("classified", auto, "id", [columns[0], columns[2], "date_labelled"], merge_max=("date_labelled",))
        asked = labels.to_ask(rows, kind)
        prompt = F.lit(c.prompt(kind.name))
        if kind.by_pillar:
            prompt = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in kind.categories for x in (p, c.prompt(f"{kind.name}.{p}"))]), F.col("pillar_curated")), prompt)
        tools = {p: verdicts.label_tool(f"label_{kind.name}", f"Record the {kind.output} of the document.", cats, kind.secondary) for p, cats in kind.categories.items()}
        text = F.try_element_at(F.create_map(*[F.lit(x) for p, t in tools.items() for x in (p, json.dumps(t))]), F.col("pillar_curated")) if kind.by_pillar else None
        batch, completed = submitted(c.batch_folder, f"label-{kind.name}", client, verdicts.requests(asked, next(iter(tools.values())), c.model, 150, prompt, tool_text=text), poll)
        every = [x for group in kind.categories.values() for x in group]
        answers = verdicts.parse_labels(client.results(c.spark, batch), every, kind.name)
        given = asked.drop(*columns).join(answers, "id")
        if kind.by_pillar:  # a category of another pillar is no answer
            fits = F.array_contains(F.try_element_at(F.create_map(*[x for p, cats in kind.categories.items() for x in (F.lit(p), F.array(*[F.lit(v) for v in cats]))]), F.col("pillar_curated")), F.col(columns[0]))
            given = given.withColumn(columns[2], F.when((F.col(columns[2]) == "ok") & ~F.coalesce(fits, F.lit(False)), "parse_error").otherwise(F.col(columns[2])))
        spread = labels.spread(rows.drop(*columns), given, columns).withColumn("date_labelled", stamp())
        c.store.update("classified", spread, "id", [*columns, "date_labelled"], merge_max=("date_labelled",))
        completed()
    done = c.store.read("labelled").select("id") if c.store.exists("labelled") else None
    c.store.append_or_create("labelled", labels.assemble(c.store.read("classified"), done, c.label_types))


def export(c: Corpus, path: str, one_file: bool = False) -> None:
    """The labelled table as CSV, without an index column; as one file, which one task writes, only if asked for."""
    files.write_csv(c.store.read("labelled"), path, one_file)
