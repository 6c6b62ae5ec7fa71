"""The layer: rows plus contract, with every operation as a method."""

from __future__ import annotations

import logging
import uuid
from dataclasses import replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from lamina.errors import InvalidParameterError
from lamina.operators import attachments as att
from lamina.operators.diff import diff
from lamina.operators.edits import EditJob, EditOutcome
from lamina.operators.query import QueryPlan, QueryResult
from lamina.plans.contract import FieldSet, LayerContract
from lamina.session import pin_utc
from lamina.sources.store import LayerStore

log = logging.getLogger(__name__)


class Layer:
    """A table described by a contract.

    Over a DataFrame, an edit returns a new layer's rows and leaves this one as it
    is. Over a :class:`LayerStore` the edit is also committed as the next version,
    and later calls on the same layer see it.
    """

    def __init__(
        self,
        df: DataFrame | None,
        contract: LayerContract,
        *,
        attachments: DataFrame | None = None,
        store: LayerStore | None = None,
        attachment_store: LayerStore | None = None,
        identity: str | None = None,
    ):
        #: What tells this layer's global ids from another's; a store has its own.
        self.identity = identity or uuid.uuid4().hex
        self._df, self.contract, self.store = df, contract, store
        self._attachments, self.attachment_store = attachments, attachment_store
        pin_utc(self.rows.sparkSession)

    @classmethod
    def from_parquet(
        cls, spark: SparkSession, path: str, contract: LayerContract, **kwargs: Any
    ) -> Layer:
        return cls(spark.read.parquet(path), contract, **kwargs)

    @property
    def rows(self) -> DataFrame:
        return self._df if self.store is None else self.store.read()

    @property
    def attachments(self) -> DataFrame:
        if self.attachment_store is not None:
            return self.attachment_store.read()
        if self._attachments is None:
            raise InvalidParameterError("The layer has no attachment table.")
        return self._attachments

    # ---- description ------------------------------------------------------

    @property
    def fields(self) -> FieldSet:
        return self.contract.fields

    # ---- queries ----------------------------------------------------------

    def plan(
        self,
        where: str = "1=1",
        out_fields: list[str] | str | None = None,
        return_geometry: bool = True,
        out_sr: int | None = None,
        apply_coded_values: bool = False,
        **options: Any,
    ) -> QueryPlan:
        """Checked arguments of a query, for output forms that :meth:`query` lacks."""
        self.contract.require(self.contract.supports_query, "query operations")
        return QueryPlan(
            self.rows,
            self.contract,
            where,
            out_fields,
            return_geometry,
            out_sr,
            apply_coded_values,
            options,
        )

    def query(
        self,
        where: str = "1=1",
        out_fields: list[str] | str | None = None,
        return_geometry: bool = True,
        out_sr: int | None = None,
        apply_coded_values: bool = False,
        **options: Any,
    ) -> QueryResult:
        """Rows that match, as one lazy plan. ``where`` is any Spark SQL condition, so
        take it from trusted callers only; ``options`` are the service's query options."""
        return self.plan(
            where, out_fields, return_geometry, out_sr, apply_coded_values, **options
        ).run()

    def count(self, where: str = "1=1", **options: Any) -> int:
        return self.query(where, returnCountOnly=True, **options).df.first()["count"]

    # ---- edits ------------------------------------------------------------

    def _job(self, rollback_on_failure: bool, **kwargs: Any) -> EditJob:
        self.contract.require(self.contract.supports_apply_edits, "edit operations")
        if not rollback_on_failure and not self.contract.supports_rollback_parameter:
            log.warning("The layer does not support rollback_on_failure=False; batches roll back.")
            rollback_on_failure = True
        state = {} if self.store is None else self.store.state()
        return EditJob(
            self._df if self.store is None else self.store.read(state=state),
            self.contract,
            rollback_on_failure=rollback_on_failure,
            next_object_id=state.get("next_object_id"),
            buckets=state.get("buckets"),
            identity=state.get("layer_id") or self.identity,
            base=state or None,
            **kwargs,
        )

    def _commit(self, job: EditJob, outcome: EditOutcome) -> EditOutcome:
        """Write the buckets the edit touches, as the version after the one it was made from."""
        change = outcome.change
        if self.store is None or change is None:
            return outcome
        base, added = job.base, change.added()
        touched = change.touched(lambda key: self.store.bucket_of(key, base))
        if added is not None:
            touched = sorted({*touched, *self.store.crowded(base)})
        new = change.rows(self.store.read(state=base, buckets=touched)) if touched else None
        if added is not None:
            new = added if new is None else new.unionByName(added)
        self.store.commit(
            new,
            base=base,
            replaced=touched,
            next_object_id=job.next_object_id + outcome.n_adds if outcome.n_adds else None,
            results=outcome.results.metadata_frame(),
        )
        return replace(outcome, rows=self.store.read())

    def apply_edits(
        self,
        adds: DataFrame | None = None,
        updates: DataFrame | None = None,
        deletes: Any = None,
        *,
        rollback_on_failure: bool = True,
        apply_coded_values: bool = False,
        max_batch_bytes: int | None = None,
    ) -> EditOutcome:
        """Apply edits batch by batch; failures of rows are results, never exceptions."""
        job = self._job(
            rollback_on_failure,
            apply_coded_values=apply_coded_values,
            max_batch_bytes=max_batch_bytes,
        )
        return self._commit(job, job.apply(adds, updates, deletes))

    def edit_bodies(
        self,
        adds: DataFrame | None = None,
        updates: DataFrame | None = None,
        deletes: Any = None,
        *,
        apply_coded_values: bool = False,
        max_batch_bytes: int | None = None,
    ) -> DataFrame:
        """The edits as request bodies, ``(batch_id, body)``, without applying them."""
        job = self._job(
            True, apply_coded_values=apply_coded_values, max_batch_bytes=max_batch_bytes
        )
        return job.bodies(adds, updates, deletes)

    def append(self, df: DataFrame, **kwargs: Any) -> EditOutcome:
        """Add every row; object ids are given out by the layer."""
        return self.apply_edits(adds=df, **kwargs)

    def upsert(self, df: DataFrame, key_fields: list[str], **kwargs: Any) -> EditOutcome:
        """Update rows whose key the layer has, add the others; nothing is deleted."""
        return self._merge(df, key_fields, False, **kwargs)

    def sync(self, df: DataFrame, key_fields: list[str], **kwargs: Any) -> EditOutcome:
        """Upsert, and delete layer rows whose key the input lacks. Every row with a
        known key is updated, changed or not; an empty input empties the layer."""
        return self._merge(df, key_fields, True, **kwargs)

    def _merge(
        self,
        df: DataFrame,
        key_fields: list[str],
        delete_missing: bool,
        *,
        rollback_on_failure: bool = True,
        apply_coded_values: bool = False,
        max_batch_bytes: int | None = None,
    ) -> EditOutcome:
        job = self._job(
            rollback_on_failure,
            apply_coded_values=apply_coded_values,
            max_batch_bytes=max_batch_bytes,
        )
        return self._commit(job, job.merge(df, key_fields, delete_missing=delete_missing))

    def diff(
        self, df: DataFrame, key_fields: list[str], *, apply_coded_values: bool = False
    ) -> tuple[DataFrame, DataFrame, DataFrame]:
        """What upsert and sync would send, without sending it."""
        return diff(df, self.rows, self.contract, key_fields, apply_coded_values)

    # ---- attachments ------------------------------------------------------

    def query_attachments(self, **arguments: Any) -> att.AttachmentsQueryResult:
        c = self.contract
        c.require(c.supports_query_attachments, "attachment queries")
        if arguments.get("return_count_only"):
            c.require(c.supports_query_attachments_count_only, "counting attachments")
        return att.AttachmentQuery(c, **arguments).run(self.attachments, self.rows)

    def _requests(self, rows: list[tuple]) -> DataFrame:
        return self.rows.sparkSession.createDataFrame(rows, att.REQUEST_SCHEMA)

    def add_attachments(
        self,
        object_ids: Any = None,
        files: Any = None,
        filenames: Any = None,
        content_types: Any = None,
        *,
        requests: DataFrame | None = None,
        folder: str | None = None,
    ) -> att.AttachmentOutcome:
        """Attach files given as lists, or as a request table; paths lie below ``folder``."""
        self.contract.require(self.contract.has_attachments, "attachments")
        if requests is None:
            requests = self._requests(
                att.request_rows(object_ids, files, filenames, content_types)
            )
        base, table = self._attachment_state()
        outcome = att.add_attachments(
            table,
            self.rows,
            self.contract,
            requests,
            self._files(folder),
            first_id=base.get("next_object_id"),
            identity=base.get("layer_id") or f"{self.identity}/attachments",
        )
        return self._commit_attachments(outcome, base)

    def update_attachments(
        self,
        object_ids: Any = None,
        attachment_ids: Any = None,
        files: Any = None,
        filenames: Any = None,
        content_types: Any = None,
        *,
        requests: DataFrame | None = None,
        folder: str | None = None,
    ) -> att.AttachmentOutcome:
        """Replace files of existing attachments."""
        self.contract.require(self.contract.has_attachments, "attachments")
        self.contract.require(self.contract.supports_update, "updating attachments")
        if requests is None:
            requests = self._requests(
                att.request_rows(object_ids, files, filenames, content_types, attachment_ids)
            )
        base, table = self._attachment_state()
        outcome = att.update_attachments(table, requests, self._files(folder))
        return self._commit_attachments(outcome, base)

    def delete_attachments(
        self, object_ids: Any = None, attachment_ids: Any = None, *, pairs: DataFrame | None = None
    ) -> att.AttachmentOutcome:
        """Delete attachments by (object id, attachment id) pair."""
        self.contract.require(self.contract.has_attachments, "attachments")
        if pairs is None:
            pairs = self.rows.sparkSession.createDataFrame(
                att.delete_pairs(object_ids, attachment_ids), "parentObjectId bigint, id bigint"
            )
        base, table = self._attachment_state()
        return self._commit_attachments(att.delete_attachments(table, pairs), base)

    def _files(self, folder: str | None) -> DataFrame | None:
        return None if folder is None else att.read_files(self.rows.sparkSession, folder)

    def _attachment_state(self) -> tuple[dict, DataFrame]:
        """The stored version of the attachment table, {} if it is not stored, and its rows."""
        if self.attachment_store is None:
            return {}, self.attachments
        state = self.attachment_store.state()
        if state["key"] != "id":
            raise InvalidParameterError("An attachment store is laid out by the attachments' id.")
        return state, self.attachment_store.read(state=state)

    def _commit_attachments(self, outcome: att.AttachmentOutcome, base: dict) -> att.AttachmentOutcome:
        """Write the buckets whose files change, as the version after the one the edit was made from."""
        store, change = self.attachment_store, outcome.change
        if store is None:
            return outcome
        kind = outcome.attachments.schema[base["key"]].dataType
        touched = change.touched(lambda key: store.bucket_of(key, base), kind)
        if change.new is not None:
            touched = sorted({*touched, *store.crowded(base)})
        new = change.kept(store.read(state=base, buckets=touched)) if touched else None
        if change.new is not None:
            added = change.new.repartition(base["buckets"], f"`{base['key']}`")
            new = added if new is None else new.unionByName(added)
        store.commit(
            new,
            base=base,
            replaced=touched,
            next_object_id=base["next_object_id"] + outcome.n_adds if outcome.n_adds else None,
            results=outcome.results.items,
        )
        return replace(outcome, attachments=store.read())
