"""Applying adds, updates and deletes to a layer.

Nothing is changed in place. The inputs are written once with a row tag, every
edit is judged and packed into a batch, and the outcome is a results table and a
new state of the layer, both derived from the written tables only.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions import geometry as geo
from lamina.functions.coerce import CoercionReport
from lamina.operators import diff as keys
from lamina.operators import sizes
from lamina.operators.batches import (
    DEFAULT_MAX_BATCH_BYTES,
    KINDS,
    Pack,
    batch_bodies,
    check_batch_bytes,
    delete_size,
    pack_edits,
)
from lamina.operators.numbering import place_in_task, task_of
from lamina.operators.payloads import (
    feature_json,
    geometry_of,
    sent_frame,
    stored_columns,
    writable_columns,
)
from lamina.operators.results import (
    ERROR_TYPE,
    HIDDEN_COLUMNS,
    NO_OBJECT_ID,
    EditResults,
    engine_error,
    error_struct,
)
from lamina.operators.skew import join_spread
from lamina.plans.contract import GEOMETRY_COLUMN, LayerContract
from lamina.session import TASK, Staging

SEQ = "_seq"
# Error of every edit in a batch that was rolled back.
ROLLBACK_CODE = 400
ROLLBACK_EXTENDED_CODE = "-2146"
ROLLBACK_MESSAGE = "Unable to complete operation."
ROLLBACK_DETAIL = "Operation rolled back."


@dataclass(frozen=True)
class EditOutcome:
    """What an edit call produced: per-edit results and the layer's new rows.

    ``dropped`` lists input columns that were not sent, ``reports`` what the coercion
    changed, per kind, or under ``input`` for the one input of an upsert or sync.
    """

    results: EditResults
    rows: DataFrame
    dropped: dict[str, list[str]]
    reports: dict[str, CoercionReport]
    n_adds: int = 0
    staging: Staging | None = None
    change: LayerChange | None = None

    def release(self) -> None:
        """Delete the working tables. ``results`` and ``rows`` read them, so call this
        once what is needed of both has been written elsewhere."""
        if self.staging is not None:
            self.staging.release()

    @property
    def items(self) -> DataFrame:
        return self.results.items


@dataclass(frozen=True)
class LayerChange:
    """What an edit does to rows, for a store that rewrites only the buckets it touches."""

    job: EditJob
    items: DataFrame
    pack: Pack

    def touched(self, bucket_of: Callable[[Column], Column]) -> list[int]:
        """Buckets of the rows that are updated or deleted, at most all buckets there are."""
        kind = self.job.layer.schema[self.job.oid].dataType
        done = self.items.where(F.col("success") & F.col("kind").isin("updates", "deletes"))
        found = done.select(bucket_of(F.col("oid").cast(kind)).alias("bucket")).distinct()
        return sorted(r["bucket"] for r in found.collect())

    def rows(self, layer: DataFrame) -> DataFrame:
        """These rows of the layer after its updates and deletes."""
        return self.job.kept_rows(layer, self.items, self.pack)

    def added(self) -> DataFrame | None:
        return self.job.added_rows(self.items, self.pack)


def tag_input(df: DataFrame) -> DataFrame:
    """``df`` with a row tag in input order; write it before using it twice."""
    return df.withColumn(SEQ, F.monotonically_increasing_id())


def global_id(identity: str, number: Column) -> Column:
    """The id a table of that identity gives the row of that number."""
    digest = F.upper(F.md5(F.concat(F.lit(f"{identity}/"), number.cast("string"))))
    parts = [F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("{"), F.concat_ws("-", *parts), F.lit("}"))


def deletes_frame(deletes: Any, layer: DataFrame, objectid_field: str) -> DataFrame | None:
    """Deletes as a DataFrame with the object id column: a DataFrame is kept as it
    is, a list of ids becomes one column, None stays None."""
    if deletes is None or isinstance(deletes, DataFrame):
        return deletes
    schema = T.StructType([T.StructField(objectid_field, T.LongType())])
    return layer.sparkSession.createDataFrame([(int(i),) for i in deletes], schema)


class EditJob:
    """One edit call over a layer's rows."""

    def __init__(
        self,
        layer: DataFrame,
        contract: LayerContract,
        *,
        rollback_on_failure: bool = True,
        apply_coded_values: bool = False,
        max_batch_bytes: int | None = None,
        next_object_id: int | None = None,
        buckets: int | None = None,
        identity: str | None = None,
        base: dict | None = None,
    ):
        self.max_bytes = DEFAULT_MAX_BATCH_BYTES if max_batch_bytes is None else max_batch_bytes
        check_batch_bytes(self.max_bytes)
        self.layer, self.contract = layer, contract
        self.oid = contract.objectid_field
        self.rollback = rollback_on_failure
        self.apply_coded_values = apply_coded_values
        self.next_object_id = next_object_id
        self.buckets = buckets
        self.identity = identity or uuid.uuid4().hex
        self.base = base  # the stored version these rows are of
        self.staging = Staging(layer.sparkSession)
        self.inputs: dict[str, DataFrame] = {}
        self._is_merge, self.n_parts = False, 0
        self.names: dict[str, list[str]] = {}
        self.dropped: dict[str, list[str]] = {}
        self.reports: dict[str, CoercionReport] = {}

    # ---- ways in ----------------------------------------------------------

    def apply(self, adds: DataFrame | None, updates: DataFrame | None, deletes: Any) -> EditOutcome:
        """Adds, updates and deletes as given; updates and deletes must exist."""
        self._take_in(adds, updates, deletes)
        judged = {kind: self._judge(kind, self.inputs[kind]) for kind in self.inputs}
        targets = [judged[k] for k in ("updates", "deletes") if k in judged]
        if targets:
            checked = self._require_existing(reduce(DataFrame.unionByName, targets))
            judged = {k: v for k, v in judged.items() if k == "adds"} | {"targets": checked}
        return self._finish(list(judged.values()))

    def merge(self, df: DataFrame, key_fields: list[str], *, delete_missing: bool) -> EditOutcome:
        """Upsert, or sync if layer rows without an input row are to be deleted."""
        keys.check_key_names(df, key_fields)
        self.contract.check_names(key_fields)
        self.n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        source = self.staging.write_by_task(tag_input(df), "input", SEQ, self.n_parts)
        args = (self.layer, self.contract, key_fields, self.apply_coded_values)
        keys.check_unique_keys(source, *args)
        small = sizes.is_small(source, key_fields)
        self.inputs = {"adds": source, "updates": source}
        self._is_merge = True
        # keys meet the layer with what judging found, the rows themselves stay where they are
        matched = keys.match_input(self._judge_both(source, key_fields), *args, small_input=small)
        judged = [self._judge_matched(matched)]
        if delete_missing:
            gone = keys.deletes_of(source, *args, small_input=small)
            ordered = gone.repartitionByRange(self.oid).sortWithinPartitions(self.oid)
            self.inputs["deletes"] = self.staging.write(tag_input(ordered), "deletes")
            judged.append(self._judge("deletes", self.inputs["deletes"]))
        return self._finish(judged)

    def bodies(self, adds: DataFrame | None, updates: DataFrame | None, deletes: Any) -> DataFrame:
        """Request bodies that would send the edits, one JSON text per batch, in order
        of ``batch_id``; nothing is applied."""
        self._take_in(adds, updates, deletes)
        if not self.inputs:
            return self.layer.sparkSession.createDataFrame([], "batch_id bigint, body string")
        judged = [self._judge(kind, df) for kind, df in self.inputs.items()]
        written = self.staging.write(reduce(DataFrame.unionByName, judged), "judged")
        packed = pack_edits(written, self.max_bytes).edits.select("kind_rank", "seq", "oid", "position", "batch_id")
        parts = [self._features(kind, packed) for kind in self.inputs]
        return batch_bodies(reduce(DataFrame.unionByName, parts))

    def _features(self, kind: str, packed: DataFrame) -> DataFrame:
        """One kind's packed edits with their feature JSON."""
        edits = packed.where(F.col("kind_rank") == KINDS.index(kind))
        feature = F.lit(None).cast("string").alias("feature")
        if kind != "deletes":
            names, sent = self._sent(kind, self.inputs[kind])
            found = sent.select(
                F.col(SEQ), feature_json(names, geometry_of(sent)).alias("feature")
            )
            edits, feature = edits.join(found, F.col("seq") == F.col(SEQ)), F.col("feature")
        return edits.select("batch_id", F.lit(kind).alias("kind"), "position", feature, "oid")

    def _take_in(self, adds: DataFrame | None, updates: DataFrame | None, deletes: Any) -> None:
        frames = {
            "adds": adds,
            "updates": updates,
            "deletes": deletes_frame(deletes, self.layer, self.oid),
        }
        for kind, df in frames.items():
            if df is not None:
                self.inputs[kind] = self.staging.write(tag_input(df), kind)

    # ---- judging ----------------------------------------------------------

    def _judge(self, kind: str, rows: DataFrame) -> DataFrame:
        """Narrow view of one kind's edits: sequence, object id, size, first problem."""
        oid = self._given_oid(kind, rows)
        if kind == "deletes":
            return rows.select(
                F.lit(KINDS.index(kind)).alias("kind_rank"),
                F.col(SEQ).alias("seq"),
                oid.alias("oid"),
                F.lit(None).cast("string").alias("problem"),
                F.coalesce(delete_size(oid), F.lit(2)).cast("bigint").alias("size"),
            )
        names, sent = self._sent(kind, rows.withColumn("_oid", oid))
        if kind == "updates":
            sent = sent.withColumn(self.oid, F.col("_oid"))
        geometry = geometry_of(rows)
        size = F.octet_length(feature_json(names, geometry))
        return sent.select(
            F.lit(KINDS.index(kind)).alias("kind_rank"),
            F.col(SEQ).alias("seq"),
            F.col("_oid").alias("oid"),
            self._problem(kind, names, geometry).alias("problem"),
            size.cast("bigint").alias("size"),
        )

    def _judge_both(self, source: DataFrame, key_fields: list[str]) -> DataFrame:
        """Tag and keys of every input row as sent, and what to say of it as an add and as an
        update: the first problem and the size, of an update that without its object id."""
        _, self.dropped["adds"] = writable_columns(
            source.drop(*HIDDEN_COLUMNS), self.contract, with_oid=False
        )
        raw = {f"_sent_{k}": F.col(f"`{k}`") for k in key_fields}
        names, sent = self._sent("updates", source, raw)
        self.names["adds"] = self.names["updates"]
        self.reports = {"input": self.reports["updates"]}
        sent = sent.withColumn(self.oid, F.lit(0))
        geometry = geometry_of(source)
        without_id = F.octet_length(feature_json(names, geometry)) - 1
        return sent.select(
            F.col(SEQ),
            *[F.col(f"`{r}`").alias(k) for r, k in zip(raw, key_fields)],
            self._problem("adds", self.names["adds"], geometry).alias("_add_problem"),
            self._problem("updates", names, geometry).alias("_update_problem"),
            F.octet_length(feature_json(self.names["adds"], geometry)).alias("_add_size"),
            without_id.alias("_update_size"),
        )

    def _judge_matched(self, matched: DataFrame) -> DataFrame:
        """Narrow view of the edits an input comes to, its rows being adds or updates."""
        is_update, oid = F.col(keys.IS_MATCHED), F.col(keys.MATCHED_OID).cast("bigint")
        size = F.when(
            is_update, F.col("_update_size") + F.octet_length(F.coalesce(oid.cast("string"), F.lit("0")))
        ).otherwise(F.col("_add_size"))
        problem = F.when(is_update, F.col("_update_problem")).otherwise(F.col("_add_problem"))
        return matched.select(
            F.when(is_update, KINDS.index("updates")).otherwise(KINDS.index("adds")).alias("kind_rank"),
            F.col(SEQ).alias("seq"),
            oid.alias("oid"),
            problem.alias("problem"),
            size.cast("bigint").alias("size"),
        )

    def _sent(
        self, kind: str, rows: DataFrame, extra: dict[str, Column] | None = None
    ) -> tuple[list[str], DataFrame]:
        """Rows with their sent values, and the columns of a payload; ``extra`` columns are
        taken along as the input has them."""
        with_oid = kind == "updates"
        names, self.dropped[kind] = writable_columns(
            rows.drop(*HIDDEN_COLUMNS), self.contract, with_oid=with_oid
        )
        self.names[kind] = [n for n in names if n != self.oid]
        sent, self.reports[kind] = sent_frame(
            rows.withColumns(extra) if extra else rows,
            self.contract, self.names[kind], self.apply_coded_values,
        )
        return ([self.oid, *self.names[kind]] if with_oid else self.names[kind]), sent

    def _problem(self, kind: str, names: list[str], geometry: Column | None) -> Column:
        """Text of the first reason to refuse an add or update, else null.

        An add must give every editable non-nullable field a value, an update only
        those it sends.
        """
        required = self.contract.fields.filter(editable=True, nullable=False).names
        checks = []
        for n in required:
            if n in names:
                checks.append(F.when(F.col(f"`{n}`").isNull(), F.lit(f"Field '{n}' cannot be null.")))
            elif kind == "adds":
                checks.append(F.lit(f"Field '{n}' cannot be null."))
        if geometry is not None:
            text = F.concat(F.lit("A geometry of type "), geometry["type"], F.lit(" cannot be stored."))
            checks.append(F.when(geo.is_unsupported(geometry), text))
        return F.coalesce(*checks, F.lit(None).cast("string"))

    def _require_existing(self, targets: DataFrame) -> DataFrame:
        """Mark updates and deletes whose object id the layer does not have.

        A small edit set is broadcast to the layer's id column; a large one meets it in a
        shuffle, and edits that crowd under one id, or under none, are spread.
        """
        ids = self.layer.select(F.col(f"`{self.oid}`").cast("bigint").alias("_layer_oid"))
        n_rows = sum(self.inputs[k].count() for k in ("updates", "deletes") if k in self.inputs)
        if n_rows <= sizes.MAX_BROADCAST_ROWS:
            wanted = F.broadcast(targets.select(F.col("oid").alias("_wanted")).distinct())
            # at most as many rows as the edits have
            found = F.broadcast(
                ids.join(wanted, F.col("_layer_oid") == F.col("_wanted"), "left_semi")
            )
            joined = targets.join(found, F.col("oid") == F.col("_layer_oid"), "left")
        else:
            targets = self.staging.write(targets, "targets")
            joined = join_spread(targets, ids, [("oid", "_layer_oid")], "left", F.col("seq"))
        missing = F.when(
            F.col("_layer_oid").isNull(),
            F.concat(
                F.lit("Object id "),
                F.coalesce(F.col("oid").cast("string"), F.lit("null")),
                F.lit(" does not exist."),
            ),
        )
        return joined.withColumn("problem", F.coalesce(missing, F.col("problem"))).drop("_layer_oid")

    # ---- verdict ----------------------------------------------------------

    def _finish(self, judged: list[DataFrame]) -> EditOutcome:
        if not judged:
            return EditOutcome(self._no_results(), self.layer, {}, {})
        written = self.staging.write(reduce(DataFrame.unionByName, judged), "judged")
        pack = pack_edits(written, self.max_bytes)
        counts = pack.counts
        inputs = {k: df for k, df in self.inputs.items() if counts[k]}
        if not inputs:
            return EditOutcome(self._no_results(), self.layer, self.dropped, self.reports)
        items = self.staging.write(self._items(pack.edits, counts["adds"] > 0), "items")
        results = EditResults(items, inputs, self.oid)
        change = LayerChange(self, items, pack)
        rows, added = change.rows(self.layer), change.added()
        rows = rows if added is None else rows.unionByName(added)
        return EditOutcome(
            results, rows, self.dropped, self.reports, counts["adds"], self.staging, change
        )

    def _no_results(self) -> EditResults:
        schema = (
            "kind string, position bigint, seq bigint, oid bigint, batch_id bigint, "
            "object_id bigint, global_id string, success boolean, error "
        ) + ERROR_TYPE.simpleString()
        return EditResults(self.layer.sparkSession.createDataFrame([], schema), {}, self.oid)

    def _items(self, packed: DataFrame, any_adds: bool) -> DataFrame:
        """Outcome of every packed edit; with rollback a batch stands or falls whole."""
        problem = F.col("problem")
        error = F.when(problem.isNotNull(), engine_error(problem))
        if self.rollback:
            # a batch is bounded by its bytes, so one task can hold it
            batch = Window.partitionBy("batch_id").orderBy("kind_rank", "position").rowsBetween(
                Window.unboundedPreceding, Window.unboundedFollowing
            )
            packed = packed.withColumn("_cause", F.first(problem, ignorenulls=True).over(batch))
            cause = F.col("_cause")
            error = F.when(
                cause.isNotNull(),
                error_struct(
                    code=F.lit(ROLLBACK_CODE),
                    message=F.lit(ROLLBACK_MESSAGE),
                    details=F.array(F.lit(ROLLBACK_DETAIL), cause),
                    extra=F.create_map(F.lit("extended_code"), F.lit(ROLLBACK_EXTENDED_CODE)),
                ),
            )
        success = error.isNull()
        kind = F.get(F.array(*[F.lit(k) for k in KINDS]), F.col("kind_rank"))
        new_id = F.lit(self._first_new_id() if any_adds else 0) + F.col("position")
        object_id = F.when(
            F.col("kind_rank") == 0, F.when(success, new_id).otherwise(F.lit(NO_OBJECT_ID))
        ).otherwise(F.coalesce(F.col("oid"), F.lit(NO_OBJECT_ID)))
        return packed.select(
            kind.alias("kind"),
            "position",
            "seq",
            "oid",
            "batch_id",
            object_id.cast("bigint").alias("object_id"),
            F.when((F.col("kind_rank") == 0) & success, self._global_id(new_id)).alias("global_id"),
            success.alias("success"),
            error.alias("error"),
        )

    def _first_new_id(self) -> int:
        if self.next_object_id is None:
            top = self.layer.agg(F.max(F.col(f"`{self.oid}`"))).first()[0]
            self.next_object_id = 1 if top is None else int(top) + 1
        return self.next_object_id

    def _global_id(self, new_id: Column) -> Column:
        """A global id for a new row: one for each object id of a layer, and never one of
        another layer's; null for layers without global ids."""
        if self.contract.globalid_field is None:
            return F.lit(None).cast("string")
        return global_id(self.identity, new_id)

    # ---- new rows ---------------------------------------------------------

    def kept_rows(self, rows: DataFrame, items: DataFrame, pack: Pack) -> DataFrame:
        """Rows of the layer after the successful updates and deletes: deletes win over
        updates, and of several updates to one object id the last wins."""
        small = sizes.fits(sum(pack.counts.values()), pack.n_bytes)
        hint = F.broadcast if small else (lambda df: df)
        oid = F.col(f"`{self.oid}`")
        if pack.counts["deletes"]:
            done = items.where(F.col("success") & (F.col("kind") == "deletes"))
            gone = done.select(F.col("oid").alias("_gone")).distinct()
            rows = rows.join(hint(gone), oid == F.col("_gone"), "left_anti")
        if pack.counts["updates"]:
            rows = self._updated(rows, hint(self._last_updates(items, pack, small)))
        return rows

    def added_rows(self, items: DataFrame, pack: Pack) -> DataFrame | None:
        """New rows of the successful adds; None if there was nothing to add."""
        if not pack.counts["adds"]:
            return None
        if self._is_merge or sizes.fits(sum(pack.counts.values()), pack.n_bytes):
            small = sizes.fits(sum(pack.counts.values()), pack.n_bytes)
            return self._added(items.where(F.col("success") & (F.col("kind") == "adds")), small)
        return self._appended(items, pack)

    def _typed(self, kind: str) -> tuple[list[str], DataFrame]:
        """Input rows of one kind with sent values in the layer's column types."""
        sent, _ = sent_frame(
            self.inputs[kind],
            self.contract,
            self.names[kind],
            self.apply_coded_values,
            observe=False,
        )
        columns = stored_columns(self.contract, self.names[kind], self.layer.schema)
        geometry = []
        if GEOMETRY_COLUMN in sent.columns and GEOMETRY_COLUMN in self.layer.columns:
            here = F.col(GEOMETRY_COLUMN).withField("crs", F.lit(self.contract.crs))
            geometry = [here.cast(self.layer.schema[GEOMETRY_COLUMN].dataType).alias(GEOMETRY_COLUMN)]
        tags = [c for c in (SEQ, TASK) if c in sent.columns]
        out = sent.select(
            *tags,
            self._given_oid(kind, sent).alias("_sent_oid"),
            *[c.alias(n) for n, c in columns.items()],
            *geometry,
        )
        return [c for c in out.columns if c not in (SEQ, TASK, "_sent_oid")], out

    def _given_oid(self, kind: str, rows: DataFrame) -> Column:
        """The object id an update or delete names; null if it names none, or for an add."""
        if kind == "adds" or self.oid not in rows.columns:
            return F.lit(None).cast("bigint")
        return F.col(f"`{self.oid}`").try_cast("bigint")

    def _last_updates(self, items: DataFrame, pack: Pack, small: bool) -> DataFrame:
        """The last successful update of each object id, in the layer's column types.

        It is chosen on narrow columns. Where nearly every input row is one, as in most
        large inputs, the wide rows are only cleared of the others, not shuffled for it.
        """
        updates = items.where("kind = 'updates'")
        last = updates.where("success").groupBy(F.col("oid").alias("_oid")).agg(
            F.max_by("seq", "position").alias("_last_seq")
        )
        names, typed = self._typed("updates")
        same = F.col(SEQ) == F.col("_last_seq")
        n_others = None if small or self._is_merge else pack.counts["updates"] - last.count()
        if self._is_merge and not small:
            found = self._where_written(typed, last, "_last_seq")
        elif n_others is None or n_others > sizes.MAX_BROADCAST_ROWS:
            found = typed.join(last, same)
        else:
            found = typed.withColumn("_oid", F.col("_sent_oid"))
            if n_others:
                tags = updates.select(F.col("seq").alias("_other"))
                others = tags.join(last, F.col("_other") == F.col("_last_seq"), "left_anti")
                found = found.join(F.broadcast(others), F.col(SEQ) == F.col("_other"), "left_anti")
        return found.select(
            "_oid", F.lit(True).alias("_hit"), *[F.col(f"`{n}`").alias(f"_new_{n}") for n in names]
        )

    def _where_written(self, typed: DataFrame, narrow: DataFrame, seq: str) -> DataFrame:
        """Input rows with the narrow row of their tag, brought to where they were written."""
        placed = narrow.withColumn("_at", task_of(F.col(seq))).repartition(self.n_parts, "_at")
        same = (F.col(TASK) == F.col("_at")) & (F.col(SEQ) == F.col(seq))
        return typed.join(placed.hint("shuffle_hash"), same)

    def _updated(self, rows: DataFrame, new: DataFrame) -> DataFrame:
        names = [c.removeprefix("_new_") for c in new.columns if c.startswith("_new_")]
        joined = rows.join(new, F.col(f"`{self.oid}`") == F.col("_oid"), "left")
        columns = []
        for name in rows.columns:
            old, sent = F.col(f"`{name}`"), F.col(f"`_new_{name}`")
            if name == GEOMETRY_COLUMN and name in names:
                old = F.coalesce(sent, old)  # an omitted geometry leaves the old one
            elif name in names:
                old = F.when(F.col("_hit"), sent).otherwise(old)  # a sent null is a null
            columns.append(old.alias(name))
        return joined.select(*columns)

    def _added(self, done: DataFrame, small: bool) -> DataFrame:
        """New rows of the successful adds, which may be some of many input rows."""
        names, typed = self._typed("adds")
        ids = done.select(F.col("seq").alias("_new_seq"), "object_id", "global_id")
        if self._is_merge and not small:
            joined = self._where_written(typed, ids, "_new_seq")
        else:
            joined = typed.join(ids, F.col(SEQ) == F.col("_new_seq"))
        return self._layer_rows(joined, names, F.col("object_id"), F.col("global_id"))

    def _appended(self, items: DataFrame, pack: Pack) -> DataFrame:
        """New rows of a large input that is all adds. An add's position follows from its
        tag, so the input is not shuffled to meet its ids, only cleared of failures."""
        names, typed = self._typed("adds")
        failed = items.where((F.col("kind") == "adds") & ~F.col("success"))
        failed = failed.select(F.col("seq").alias("_failed"))
        n_failed = failed.count()
        if n_failed:
            if n_failed <= sizes.MAX_BROADCAST_ROWS:
                failed = F.broadcast(failed)
            typed = typed.join(failed, F.col(SEQ) == F.col("_failed"), "left_anti")
        starts = pack.starts.where(F.col("kind_rank") == 0).select("task", "start")
        placed = typed.withColumn("task", task_of(F.col(SEQ))).join(F.broadcast(starts), "task")
        new_id = F.lit(self._first_new_id()) + F.col("start") + place_in_task(F.col(SEQ))
        return self._layer_rows(placed, names, new_id, self._global_id(new_id))

    def _layer_rows(
        self, rows: DataFrame, names: list[str], object_id: Column, global_id: Column
    ) -> DataFrame:
        columns = []
        for f in self.layer.schema:
            if f.name == self.oid:
                value = object_id
            elif f.name == self.contract.globalid_field:
                value = global_id
            elif f.name in names:
                value = F.col(f"`{f.name}`")
            else:
                value = F.lit(None)
            columns.append(value.cast(f.dataType).alias(f.name))
        new = rows.select(*columns)
        # one task per bucket, so that each writes one file
        return new.repartition(self.buckets, self.oid) if self.buckets else new
