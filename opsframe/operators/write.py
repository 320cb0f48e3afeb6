"""Batches of commands applied to a keyed state.

Each function takes a state ``s`` (one row per key) and commands ``c``, and returns the new
state with the outcomes. The caller saves the state.

An outcome row stands for ``commands`` commands of one key that fared alike. Commands are
reduced to one row per key before they meet the state, by aggregates that start before the
shuffle, so a key that most commands share costs one row per input task. The state is
first cut to the commanded keys by a semi join: where the commands are small enough for
Spark to broadcast, the state is only scanned.

Commands take the state's types before anything else. A value, at any depth, or a key that
does not fit its column without loss makes its command invalid, by the path of what does
not fit; a key that does not fit is null in the outcome. The rest of the batch goes on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from opsframe.functions.fits import (
    as_column, fitted, misfit_at, row_misfit, same_kind, text_fitted, text_misfit,
)
from opsframe.functions.items import item_bytes
from opsframe.functions.predicates import col, literal_for
from opsframe.operators.joins import split_join

APPLIED, CONFLICT, NOT_FOUND, INVALID = "applied", "conflict", "not_found", "invalid"


class Change(NamedTuple):
    state: DataFrame
    outcomes: DataFrame


_EARLIER = "an earlier command for this key was applied"


class WriteError(Exception):
    """Raised by ``strict`` when a command was not applied."""


def strict(change: Change) -> DataFrame:
    failed = change.outcomes.where(F.col("outcome") != APPLIED).take(5)
    if failed:
        raise WriteError("; ".join(str(r.asDict()) for r in failed))
    return change.state


# -- shared steps -----------------------------------------------------------------------

def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[str], first: bool = False) -> DataFrame:
    """The last (or first) row of every key.

    Spark limits each group to one row before the shuffle as well as after it.
    """
    direction = F.asc if first else F.desc
    window = Window.partitionBy(*keys).orderBy(*[direction(c) for c in order])
    return rows.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")


def hits(s: DataFrame, c: DataFrame, keys: Sequence[str], columns: Sequence[str] = ()) -> DataFrame:
    """The state rows the commands name, cut to the wanted columns, flagged ``_hit``."""
    wanted = c.select(*keys).distinct()
    return (s.select(*keys, *columns).join(wanted, list(keys), "left_semi")
            .withColumn("_hit", F.lit(True)))


def key_given(keys: Sequence[str]) -> Column:
    given = F.lit(True)
    for k in keys:
        given = given & col(k).isNotNull()
    return given


# Why a command's key or values do not fit, beside a command whose types are not the state's.
_KEY_MISFIT, _MISFIT = "_key_misfit", "_misfit"


def _typed(c: DataFrame, like: DataFrame, columns: Sequence[str], into: str) -> DataFrame:
    kinds = {f.name: f.dataType for f in like.schema.fields}
    other = [n for n in columns if n in kinds and n in c.columns and not same_kind(c.schema[n].dataType, kinds[n])]
    if not other:
        return c
    return c.withColumns({into: F.coalesce(_told(c, into), row_misfit(c, like, other)),
                          **{n: as_column(c, like, n) for n in other}})


def _told(c: DataFrame, name: str) -> Column:
    return F.col(name) if name in c.columns else F.lit(None).cast("string")


def keyed(c: DataFrame, s: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The commands with keys of the state's types, null where they do not fit."""
    return _typed(c, s, keys, _KEY_MISFIT)


def valued(c: DataFrame, s: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The commands with the state's types in these columns, null where they do not fit."""
    return _typed(c, s, columns, _MISFIT)


def checked(c: DataFrame, s: DataFrame, keys: Sequence[str]) -> DataFrame:
    return valued(keyed(c, s, keys), s, [n for n in c.columns if n not in keys])


def misfit(c: DataFrame) -> Column:
    """The reason a command's values do not fit the state's columns; null when they fit."""
    return _told(c, _MISFIT)


def _absent_key(c: DataFrame) -> Column:
    return F.coalesce(_told(c, _KEY_MISFIT), F.lit("key missing"))


def clock(s: DataFrame, column: str, as_of) -> Column:
    return literal_for(s, column, as_of)


def stamped(s: DataFrame, as_of, *columns: str) -> dict[str, Column]:
    return {c: clock(s, c, as_of) for c in columns if c in s.columns}


def _outcome(outcome, reason, commands) -> Column:
    return F.struct(
        (F.lit(outcome) if isinstance(outcome, str) else outcome).alias("outcome"),
        (F.lit(reason).cast("string") if not isinstance(reason, Column) else reason).alias("reason"),
        commands.cast("bigint").alias("commands"))


def listed(rows: DataFrame, keys: Sequence[str], *found: Column) -> DataFrame:
    """At most a few outcome rows per key, without the empty ones."""
    options = F.filter(F.array(*found), lambda o: o["commands"] > 0)
    return rows.select(*keys, F.inline(options))


def _reason_counts(c: DataFrame, keys: Sequence[str], bad: Column) -> DataFrame:
    """Per key: how many commands are sound, and how many are not for each reason."""
    return (c.withColumn("_bad", F.when(~key_given(keys), _absent_key(c)).otherwise(bad))
            .groupBy(*keys, "_bad").agg(F.count("*").alias("_n")))


def update_outcomes(s: DataFrame, c: DataFrame, keys: Sequence[str], bad: Column) -> DataFrame:
    """Outcomes of commands that need their key to exist."""
    counted = _reason_counts(c, keys, bad)
    known = counted.join(hits(s, c, keys), list(keys), "left")
    outcome = (F.when(F.col("_bad").isNotNull(), INVALID)
               .when(F.col("_hit"), APPLIED).otherwise(NOT_FOUND))
    return known.select(*keys, outcome.alias("outcome"), F.col("_bad").alias("reason"),
                        F.col("_n").alias("commands"))


def _sound(c: DataFrame, keys: Sequence[str], bad: Column) -> DataFrame:
    return c.where(key_given(keys) & bad.isNull())


def folded_sound(c: DataFrame, keys: Sequence[str], bad: Column, pick) -> DataFrame:
    """The sound commands of each key folded by the aggregates of ``pick(ok)``.

    Soundness is a column and not a filter: a filter would be pushed below the projection
    that makes the command's fields and have them made again for each use.
    """
    ok = F.col("_ok")
    return (c.withColumn("_ok", bad.isNull()).groupBy(*keys)
            .agg(F.bool_or(ok).alias("_hit"), *pick(ok))
            .where(F.col("_hit") & key_given(keys)))


# -- inserts ----------------------------------------------------------------------------

def insert_if_absent(s: DataFrame, c: DataFrame, keys: Sequence[str], as_of,
                     order: Sequence[str], defaults: Mapping[str, Column] | None = None) -> Change:
    """Of several inserts of one new key the first wins; the others conflict.

    A command whose values do not fit the state's columns is invalid and the others go on.
    """
    keys = list(keys)
    c = checked(c, s, keys)
    bad = misfit(c)
    sound = _sound(c, keys, bad)
    new = latest(sound, keys, order, first=True).join(hits(s, sound, keys), keys, "left_anti")
    for name, value in (defaults or {}).items():
        given = col(name) if name in new.columns else F.lit(None)
        new = new.withColumn(name, F.coalesce(given, value))
    new = new.withColumns(stamped(s, as_of, "created_at", "updated_at"))
    state = s.unionByName(_aligned(new, s), allowMissingColumns=True)

    counted = _reason_counts(c, keys, bad)
    known = counted.join(hits(s, sound, keys), keys, "left")
    ok = F.col("_bad").isNull()
    fresh = F.when(ok & F.col("_hit").isNull(), 1).otherwise(0)
    outcomes = listed(
        known, keys,
        _outcome(APPLIED, None, fresh),
        _outcome(CONFLICT, F.when(F.col("_hit"), F.lit("key exists"))
                 .otherwise(F.lit("inserted by an earlier command")),
                 F.when(ok, F.col("_n") - fresh).otherwise(0)),
        _outcome(INVALID, F.col("_bad"), F.when(ok, 0).otherwise(F.col("_n"))))
    return Change(state, outcomes)


def _aligned(rows: DataFrame, s: DataFrame) -> DataFrame:
    """The rows with the state's columns and types, as far as they hold them."""
    return rows.select(*[as_column(rows, s, n).alias(n) for n in s.columns if n in rows.columns])


# -- updates ----------------------------------------------------------------------------

def partial_update(s: DataFrame, c: DataFrame, keys: Sequence[str], as_of,
                   order: Sequence[str], fields: str = "fields") -> Change:
    """Set the fields each command names in its ``fields`` map; null can be written.

    Commands of one key are folded field by field, the last one naming a field winning.
    """
    keys = list(keys)
    c = keyed(c, s, keys)
    kinds = {f.name: f.dataType for f in s.schema.fields if f.name not in keys}
    given = col(fields)

    bad = F.when(given.isNull() | (F.size(given) == 0), F.lit("no fields"))
    known = sum((F.map_contains_key(given, name).cast("int") for name in kinds), F.lit(0))
    unknown = F.array_except(F.map_keys(given), F.array(*[F.lit(k) for k in kinds]))
    bad = bad.when(known < F.size(given), F.concat(F.lit("cannot set "), F.array_join(unknown, ", ")))
    for name, kind in kinds.items():
        if not isinstance(kind, T.StringType):
            unfit = text_misfit(given[name], kind, name)
            bad = bad.when(unfit.isNotNull(), unfit)

    # The greatest (order, text) pair of the commands that name the field.
    folded = folded_sound(c, keys, bad, lambda ok: [
        F.max(F.when(ok & F.map_contains_key(given, name),
                     F.struct(*order, given[name].alias("_text")))).alias(f"_set_{i}")
        for i, name in enumerate(kinds)])
    joined = s.join(folded, keys, "left")
    changed = {
        name: F.when(F.col(f"_set_{i}").isNotNull(), text_fitted(F.col(f"_set_{i}")["_text"], kind))
        .otherwise(col(name)) for i, (name, kind) in enumerate(kinds.items())
    }
    if "updated_at" in s.columns:
        changed["updated_at"] = F.when(F.col("_hit"), clock(s, "updated_at", as_of)).otherwise(
            F.col("updated_at"))
    state = joined.select(*[changed.get(n, col(n)).alias(n) for n in s.columns])
    return Change(state, update_outcomes(s, c, keys, bad))


def update_given(s: DataFrame, c: DataFrame, keys: Sequence[str], as_of, order: Sequence[str],
                 columns: Sequence[str]) -> Change:
    """Set the typed ``columns`` a command gives; a null leaves the column alone."""
    keys = list(keys)
    present = [n for n in columns if n in c.columns]
    c = valued(keyed(c, s, keys), s, present)
    seq = F.struct(*order)
    some = F.lit(False)
    for name in present:
        some = some | col(name).isNotNull()
    bad = F.coalesce(misfit(c), F.when(~some, F.lit("nothing given")))
    folded = folded_sound(c, keys, bad, lambda ok: [
        F.max_by(col(n), F.when(ok & col(n).isNotNull(), seq)).alias(f"_new_{n}") for n in present])
    joined = s.join(folded, keys, "left")
    changed = {n: F.coalesce(F.col(f"_new_{n}"), _old(s, n)) for n in present}
    if "updated_at" in s.columns:
        changed["updated_at"] = F.when(F.col("_hit"), clock(s, "updated_at", as_of)).otherwise(
            F.col("updated_at"))
    names = [*s.columns, *[n for n in present if n not in s.columns]]
    state = joined.select(*[changed.get(n, col(n)).alias(n) for n in names])
    return Change(state, update_outcomes(s, c, keys, bad))


def _old(s: DataFrame, name: str) -> Column:
    return col(name) if name in s.columns else F.lit(None)


def set_status(s: DataFrame, c: DataFrame, keys: Sequence[str], as_of, order: Sequence[str]) -> Change:
    """``is_active``, and ``updated_by`` where a command gives it."""
    return update_given(s, c, keys, as_of, order, ["is_active", "updated_by"])


def update_stats(s: DataFrame, c: DataFrame, keys: Sequence[str], as_of, order: Sequence[str]) -> Change:
    return update_given(s, c, keys, as_of, order, ["record_count", "size_bytes", "last_updated_data"])


def _tried(s: DataFrame, c: DataFrame, keys: Sequence[str], order: Sequence[str], condition: Column,
           assign: Mapping[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """The first command of each key whose condition holds on its row, as ``_new``, and the
    outcomes of all commands. With ``assign`` the row has to be there, and ``_new`` has the
    assigned values; without, ``_new`` is the whole command.

    Conditions are taken for every command beside its row, before commands are ranked, so a
    command that does not hold never stands in the way of one that does.
    """
    on = [F.col(f"s.{k}") == F.col(f"c.{k}") for k in keys]
    bad_key, bad = _absent_key(c), misfit(c)
    tried = c.withColumns({"_bad_key": bad_key, "_bad_value": bad})
    beside = tried.alias("c").join(s.withColumn("_known", F.lit(True)).alias("s"), on, "left")
    known = F.col("s._known").isNotNull()
    needs_row, reason, values = assign is not None, F.col("c._bad_value"), F.struct("c.*")
    if needs_row:
        kinds = beside.select(*[v.alias(n) for n, v in assign.items()]).schema
        unfit = [misfit_at(v, kinds[n].dataType, s.schema[n].dataType, n) for n, v in assign.items()]
        reason = F.coalesce(reason, F.when(known, F.coalesce(*unfit)))
        values = F.struct(*[fitted(v, kinds[n].dataType, s.schema[n].dataType).alias(n) for n, v in assign.items()])
    given = F.lit(True)
    for k in keys:
        given = given & F.col(f"c.{k}").isNotNull()
    reason = F.when(~given, F.col("c._bad_key")).otherwise(reason)
    met = reason.isNull() & F.coalesce(condition, F.lit(False)) & (known if needs_row else F.lit(True))
    rows = beside.select(
        *[F.col(f"c.{k}").alias(k) for k in keys], F.struct(*[F.col(f"c.{o}") for o in order]).alias("_at"),
        reason.alias("_bad"), known.alias("_known"), met.alias("_met"), values.alias("_new"))
    first = latest(rows.where("_met").select(*keys, "_at", "_new"), keys, ["_at"], first=True)

    placed = split_join(rows.drop("_new"), first.select(*keys, F.col("_at").alias("_first")), keys, "left")
    ok = F.col("_bad").isNull() & (F.col("_known") if needs_row else F.lit(True))
    later = F.col("_at") >= F.col("_first")
    counted = placed.groupBy(*keys, "_bad").agg(
        F.count("*").alias("_n"), F.count_if(ok & F.coalesce(later, F.lit(False))).alias("_later"),
        F.count_if(ok & ~F.coalesce(later, F.lit(False))).alias("_unmet"),
        F.count_if(F.col("_bad").isNull() & ~ok).alias("_absent"))
    applied = F.when(F.col("_later") > 0, 1).otherwise(0)
    return first, listed(
        counted, keys,
        _outcome(APPLIED, None, applied),
        _outcome(CONFLICT, "condition not met", F.col("_unmet")),
        _outcome(CONFLICT, _EARLIER, F.col("_later") - applied),
        _outcome(NOT_FOUND, None, F.col("_absent")),
        _outcome(INVALID, F.col("_bad"), F.when(F.col("_bad").isNotNull(), F.col("_n")).otherwise(0)))


def conditional_update(s: DataFrame, c: DataFrame, keys: Sequence[str], as_of, order: Sequence[str],
                       condition: Column, assign: Mapping[str, Column]) -> Change:
    """Apply a command only where ``condition`` holds; write both over ``s.x`` and ``c.x``.

    Of several commands for one key the first that holds on the row is applied. Those before
    it did not meet their condition, and those after it conflict, as writers that read the
    same row and came second. A command of which an assigned value does not fit its column
    is invalid, whatever its condition.
    """
    keys = list(keys)
    first, outcomes = _tried(s, keyed(c, s, keys), keys, order, condition, assign)
    changed = {n: F.col("_new")[n] for n in assign}
    if "updated_at" in s.columns:
        changed.setdefault("updated_at", clock(s, "updated_at", as_of))
    state = s.join(first.select(*keys, "_new"), keys, "left").select(*[
        (F.when(F.col("_new").isNotNull(), changed[n]).otherwise(col(n)) if n in changed else col(n)).alias(n)
        for n in s.columns])
    return Change(state, outcomes)


# -- deletes ----------------------------------------------------------------------------

class Removal(NamedTuple):
    state: DataFrame
    outcomes: DataFrame
    removed: DataFrame


def delete_keys(s: DataFrame, c: DataFrame, keys: Sequence[str],
                condition: Column | None = None) -> Removal:
    """Of several deletes of one key the first is applied; the others find nothing.

    With a ``condition`` over the state row, a row that does not meet it stays, and the
    deletes that name it conflict.
    """
    keys = list(keys)
    c = keyed(c, s, keys)
    met = F.lit(True) if condition is None else F.coalesce(condition, F.lit(False))
    wanted = c.where(key_given(keys)).select(*keys).distinct()
    gone = wanted if condition is None else s.where(met).join(wanted, keys, "left_semi").select(*keys)
    counted = _reason_counts(c, keys, F.lit(None).cast("string"))
    tried = s.withColumn("_met", met).join(wanted, keys, "left_semi").select(*keys, "_met")
    known = counted.join(tried, keys, "left")
    done, given = F.when(F.col("_met"), 1).otherwise(0), key_given(keys)
    outcomes = listed(
        known, keys,
        _outcome(APPLIED, None, done),
        _outcome(CONFLICT, "condition not met", F.when(~F.col("_met"), F.col("_n")).otherwise(0)),
        _outcome(NOT_FOUND, None, F.when(given & F.coalesce(F.col("_met"), F.lit(True)),
                                         F.col("_n") - done).otherwise(0)),
        _outcome(INVALID, F.col("_bad"), F.when(given, 0).otherwise(F.col("_n"))))
    return Removal(s.join(gone, keys, "left_anti"), outcomes, s.where(met).join(wanted, keys, "left_semi"))


# -- upserts ----------------------------------------------------------------------------

def _replaced(s: DataFrame, new: DataFrame, keys: list[str], as_of) -> DataFrame:
    """The state with the rows of ``new`` put in, the time of creation of a replaced row kept.

    Known keys take their row in one left join, which leaves the state where it is when the
    rows are few; only the keys of the state are read again, to add the others.
    """
    rest = [n for n in s.columns if n not in keys]
    values = _aligned(new.withColumns(stamped(s, as_of, "updated_at", "created_at")), s)
    whole = values.select(*keys, F.struct(*[
        (col(n) if n in values.columns else F.lit(None).cast(s.schema[n].dataType)).alias(n) for n in rest
    ] or [F.lit(True).alias("_row")]).alias("_new"))
    kept = {"created_at"} if "created_at" in s.columns else set()
    known = s.join(whole, keys, "left").select(*[
        (col(n) if n in keys else F.coalesce(col(n), F.col("_new")[n]) if n in kept
         else F.when(F.col("_new").isNotNull(), F.col("_new")[n]).otherwise(col(n))).alias(n) for n in s.columns])
    added = values.join(s.select(*keys), keys, "left_anti")
    return known.unionByName(added, allowMissingColumns=True)


def upsert(s: DataFrame, c: DataFrame, keys: Sequence[str], as_of, order: Sequence[str],
           allowed: Column | None = None) -> Change:
    """Replace or add whole rows, the last command of a key winning.

    ``created_at`` stays that of the row replaced. A command whose values do not fit the
    state's columns is invalid. ``allowed`` is a one-value column that lets the whole batch
    through or none of it.
    """
    keys = list(keys)
    c = checked(c, s, keys)
    bad = misfit(c)
    sound = _sound(c, keys, bad)
    if allowed is not None:
        sound = sound.where(allowed)
    state = _replaced(s, latest(sound, keys, order), keys, as_of)
    ok = F.col("_bad").isNull()
    outcomes = listed(
        _reason_counts(c, keys, bad), keys,
        _outcome(APPLIED, None, F.when(ok, F.col("_n")).otherwise(0)),
        _outcome(INVALID, F.col("_bad"), F.when(ok, 0).otherwise(F.col("_n"))))
    return Change(state, outcomes)


def upsert_many(s: DataFrame, c: DataFrame, keys: Sequence[str], as_of, order: Sequence[str],
                max_bytes: int | None = None) -> Change:
    """Bulk upsert. With ``max_bytes``, one row of more bytes rejects the batch; that is a
    limit of stores of items, and a table has none unless the caller says so."""
    keys = list(keys)
    if max_bytes is None:
        return upsert(s, c, keys, as_of, order)
    payload = c.select(*[col(n) for n in c.columns if n in s.columns])
    sized = checked(c.withColumn("_over", item_bytes(payload) > max_bytes), s, keys)
    over = sized.where("_over").agg(F.count("*").alias("n")).scalar()
    change = upsert(s, c, keys, as_of, order, allowed=over == 0)
    reason = F.when(F.col("_over"), F.lit("item too large")).otherwise(misfit(sized))
    counted = (sized.withColumn("_bad", F.when(~F.col("_over") & ~key_given(keys), _absent_key(sized)).otherwise(reason))
               .groupBy(*keys, "_bad").agg(F.count("*").alias("_n")).withColumn("_ok", over == 0))
    ok = F.col("_bad").isNull()
    outcomes = listed(
        counted, keys,
        _outcome(INVALID, F.col("_bad"), F.when(ok, 0).otherwise(F.col("_n"))),
        _outcome(APPLIED, None, F.when(ok & F.col("_ok"), F.col("_n")).otherwise(0)),
        _outcome(CONFLICT, "batch rejected", F.when(ok & ~F.col("_ok"), F.col("_n")).otherwise(0)))
    return Change(change.state, outcomes)


def conditional_put(s: DataFrame, c: DataFrame, keys: Sequence[str], as_of, order: Sequence[str],
                    condition: Column) -> Change:
    """Put whole rows where ``condition`` over ``s.x`` and ``c.x`` holds.

    For a key outside the state every ``s.x`` is null, so a condition that does not allow
    for that conflicts. Of several commands for one key the first that holds is put.
    """
    keys = list(keys)
    first, outcomes = _tried(s, checked(c, s, keys), keys, order, condition)
    state = _replaced(s, first.select("_new.*"), keys, as_of)
    return Change(state, outcomes)


# -- all or nothing ---------------------------------------------------------------------

def set_active_together(s: DataFrame, ids: DataFrame, keys: Sequence[str], as_of, active: bool,
                        by: str | None = None, owner: Column | None = None) -> Change:
    """Set ``is_active`` on every id or on none, with one time for all.

    ``owner`` is a further condition on the state row. The failed conditions are counted
    into a single value, and every change is guarded by it.
    """
    keys = list(keys)
    ids = keyed(ids, s, keys)
    wanted = ids.select(*keys, _told(ids, _KEY_MISFIT).alias("_bad")).distinct()
    eligible = s if owner is None else s.where(owner)
    absent = wanted.join(hits(eligible, wanted, keys), keys, "left_anti")
    failed = absent.agg(F.count("*").alias("n")).scalar()
    joined = s.join(wanted.where(key_given(keys)).select(*keys, F.lit(True).alias("_hit")), keys, "left")
    change = F.col("_hit") & (failed == 0)
    values = {"is_active": F.lit(active), **stamped(s, as_of, "updated_at")}
    if by and "updated_by" in s.columns:
        values["updated_by"] = F.lit(by)
    state = joined.withColumn("_change", F.coalesce(change, F.lit(False))).select(*[
        (F.when(F.col("_change"), values[n]).otherwise(col(n)) if n in values else col(n)).alias(n)
        for n in s.columns])
    known = wanted.join(hits(eligible, wanted, keys), keys, "left").withColumn("_failed", failed)
    outcome = (F.when(F.col("_bad").isNotNull(), INVALID).when(F.col("_hit").isNull(), NOT_FOUND)
               .when(F.col("_failed") > 0, CONFLICT).otherwise(APPLIED))
    outcomes = known.select(
        *keys, outcome.alias("outcome"),
        F.coalesce(F.col("_bad"), F.when(F.col("_hit") & (F.col("_failed") > 0), F.lit("batch rejected"))).alias("reason"),
        F.lit(1).cast("bigint").alias("commands"))
    return Change(state, outcomes)


def activate_pipelines(s, ids, keys, as_of, by=None, active=True) -> Change:
    return set_active_together(s, ids, keys, as_of, active, by)


def activate_tables(s, ids, keys, as_of, pipeline_id, by=None, active=True) -> Change:
    """The tables must belong to the pipeline; an empty list is an error."""
    if ids.isEmpty():
        raise ValueError("table ids are needed")
    return set_active_together(s, ids, keys, as_of, active, by, F.col("pipeline_id") == pipeline_id)
