"""Inventories of what a server runs and who may do what, over tables of its catalog; settings; dependencies."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut
from .monitor import snapshot

#: What a step does next, by code.
ACTIONS = {1: "QuitWithSuccess", 2: "QuitWithFailure", 3: "GoToNextStep", 4: "GoToStep"}


def _only(df: DataFrame, name: str, wanted: str | None) -> DataFrame:
    return df if wanted is None else df.where(F.col(name) == F.lit(wanted))


def _action(code: str) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in ACTIONS.items() for x in kv])[F.col(code)], F.col(code).cast("string"))


def jobs(jobs_: DataFrame, categories: DataFrame, include_disabled: bool = True, name: str | None = None) -> DataFrame:
    found = _only(jobs_, "name", name).join(categories, "category_id", "left").drop("category_id")
    return found if include_disabled else found.where("enabled")


def job_steps(steps: DataFrame, jobs_: DataFrame, name: str | None = None) -> DataFrame:
    """steps (job_id, step_id, step_name, on_success, on_fail) with their job's name and actions as words."""
    found = steps.join(_only(jobs_, "name", name).select("job_id", F.col("name").alias("job_name")), "job_id")
    return found.withColumns({"on_success": _action("on_success"), "on_fail": _action("on_fail")})


def job_schedules(schedules: DataFrame, links: DataFrame, jobs_: DataFrame, include_disabled: bool = True, name: str | None = None) -> DataFrame:
    """schedules (schedule_id, schedule_name, enabled), also those of no job, with the jobs that links name."""
    used = links.join(jobs_.select("job_id", F.col("name").alias("job_name")), "job_id", "left")
    found = _only(schedules.join(used, "schedule_id", "left"), "job_name", name)
    return found if include_disabled else found.where("enabled")


def principals(server: DataFrame, logins: DataFrame, include_system: bool = False, name: str | None = None) -> DataFrame:
    """Server principals (principal_id, name, type, is_fixed_role) with their login's state, and logins (principal_id,
    name, type, is_disabled) that have no principal, in one shape; fixed roles and internal names if asked for."""
    known = server.join(logins.select("principal_id", "is_disabled"), "principal_id", "left").select("principal_id", "name", "type", "is_disabled", "is_fixed_role")
    alone = logins.join(server, "principal_id", "left_anti").select("principal_id", "name", "type", "is_disabled")
    both = known.unionByName(alone, allowMissingColumns=True).withColumn("is_fixed_role", F.coalesce("is_fixed_role", F.lit(False)))
    if not include_system:
        both = both.where(~F.col("name").like("##MS\\_%##") & ~F.col("is_fixed_role"))
    return _only(both, "name", name)


def role_members(memberships: DataFrame, people: DataFrame, role: str | None = None) -> DataFrame:
    """(role, member) by name from memberships (role_id, member_id) and people (principal_id, name)."""
    roles = people.select(F.col("principal_id").alias("role_id"), F.col("name").alias("role"))
    members = people.select(F.col("principal_id").alias("member_id"), F.col("name").alias("member"), F.col("type").alias("member_type"))
    return _only(memberships.join(roles, "role_id").join(members, "member_id"), "role", role).select("role", "member", "member_type")


def permissions(grants: DataFrame, people: DataFrame, securables: dict[str, DataFrame]) -> DataFrame:
    """grants (class, major_id, grantee_id, permission, state) with grantee and the securable's name: for each class
    (its name -> a table of id and name) one left join and one branch; of other classes the name is null."""
    found = grants.join(people.select(F.col("principal_id").alias("grantee_id"), F.col("name").alias("grantee")), "grantee_id", "left")
    for class_, table in securables.items():
        named = table.select(F.col("id").alias("major_id"), F.col("name").alias(f"_{class_}")).withColumn("class", F.lit(class_))
        found = found.join(named, ["class", "major_id"], "left")
    name = F.coalesce(*[F.col(f"_{c}") for c in securables], F.lit(None).cast("string"))
    return found.select("grantee", "class", name.alias("securable"), "permission", "state")


def settings(spark: SparkSession, prefix: str | None = None) -> DataFrame:
    """Settings of the session with their defaults' meaning, as a table."""
    found = spark.sql("SET -v")
    return found if prefix is None else found.where(F.col("key").startswith(prefix))


def properties(spark: SparkSession) -> DataFrame:
    """(property, value) of the instance; what isn't known is null."""
    context = spark.sparkContext
    values = {"version": spark.version, "application": context.applicationId, "master": context.master, "parallelism": str(context.defaultParallelism), "time_zone": spark.conf.get("spark.sql.session.timeZone", None), "warehouse": spark.conf.get("spark.sql.warehouse.dir", None), "ansi": spark.conf.get("spark.sql.ansi.enabled", None)}
    return spark.createDataFrame(list(values.items()), "property string, value string")


def dependencies(*sources: DataFrame) -> DataFrame:
    """(parent, child, kind) of several kinds of edges as one table; those that repeat once."""
    return reduce(DataFrame.unionByName, [s.select("parent", "child", "kind") for s in sources]).distinct()


def levels(edges: DataFrame) -> DataFrame:
    """(node, level): 0 for what depends on nothing, else one more than the deepest it depends on: the order to make
    things in. Each round takes off what depends on nothing that is left, and its edges, so rounds are as many as levels and their
    work shrinks. Raises as soon as all that is left depends on each other: a circle alone is noticed in the first round."""
    left = cut(edges.select("parent", "child").distinct())
    nodes = cut(left.select(F.col("parent").alias("node")).union(left.select("child")).distinct())
    found, level = [], 0
    while nodes.limit(1).count():
        free = cut(nodes.join(left.select(F.col("child").alias("node")).distinct(), "node", "left_anti"))
        if not free.limit(1).count():
            raise ValueError("things depend on each other in a circle")
        found.append(free.withColumn("level", F.lit(level)))
        left = cut(left.join(free.select(F.col("node").alias("parent")), "parent", "left_anti"))
        nodes, level = cut(nodes.join(free, "node", "left_anti")), level + 1
    return reduce(DataFrame.unionByName, found) if found else nodes.withColumn("level", F.lit(0))


def copy_texts(table: str, destination: str, columns: list[str], keys: list[str], where: str | None = None) -> dict[str, str]:
    """SELECT, INSERT and MERGE texts that copy one table: matched by keys, other columns updated, names quoted."""
    quoted = lambda name: ".".join("`" + s.replace("`", "``") + "`" for s in name.split("."))
    if not columns or not keys or not {k.lower() for k in keys} <= {c.lower() for c in columns}:
        raise ValueError("columns, and keys among them, are needed")
    listed = ", ".join(map(quoted, columns))
    select = f"SELECT {listed} FROM {quoted(table)}" + (f" WHERE {where}" if where else "")
    changed = [c for c in columns if c.lower() not in {k.lower() for k in keys}]
    on = " AND ".join(f"t.{quoted(k)} <=> s.{quoted(k)}" for k in keys)
    matched = f" WHEN MATCHED THEN UPDATE SET {', '.join(f't.{quoted(c)} = s.{quoted(c)}' for c in changed)}" if changed else ""
    merge = f"MERGE INTO {quoted(destination)} AS t USING ({select}) AS s ON {on}{matched} WHEN NOT MATCHED THEN INSERT ({listed}) VALUES ({', '.join(f's.{quoted(c)}' for c in columns)})"
    return {"select": select, "insert": f"INSERT INTO {quoted(destination)} ({listed}) {select}", "merge": merge}


def inventory(sections: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """All sections of an inventory, computed once; unlike a monitoring snapshot, one that fails fails it all."""
    made, errors = snapshot(sections)
    if errors:
        raise RuntimeError(f"inventory: {errors}")
    return made
