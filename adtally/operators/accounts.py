"""Reports over users and sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.operators.filters import at_least_one


def filter_users(
    users: DataFrame,
    user_id: int | None = None,
    username: str | None = None,
    active: bool | None = None,
    role: str | None = None,
    search: str | None = None,
) -> DataFrame:
    """Exact id, name, state and role, or a substring of the name ignoring case."""
    if user_id is not None:
        users = users.where(F.col("id") == int(user_id))
    if username:
        users = users.where(F.col("username") == username.strip().lower())
    if active is not None:
        users = users.where(F.col("is_active") == bool(active))
    if role:
        users = users.where(F.lower("role") == role.strip().lower())
    if search and search.strip():
        users = users.where(F.lower("username").contains(search.strip().lower()))
    return users


def list_users(users: DataFrame, limit: int = 100, offset: int = 0, **conditions) -> DataFrame:
    """A page of matching users by id with the ``total`` number of matches."""
    matches = filter_users(users, **conditions)
    total = matches.agg(F.count("*")).scalar()
    return matches.orderBy("id").offset(max(0, offset)).limit(at_least_one(limit)).withColumn("total", total)


def sessions_with_users(sessions: DataFrame, users: DataFrame, active: bool | None = None) -> DataFrame:
    """Every session with the username of its user, null for an unknown user.

    Both sides grow, so neither is forced into memory: Spark broadcasts by
    measured size or sorts, and splits a user with very many sessions.
    """
    if active is not None:
        sessions = sessions.where(F.col("is_active") == bool(active))
    names = users.select(F.col("id").alias("user_id"), "username")
    return sessions.join(names, "user_id", "left")


def list_sessions(
    sessions: DataFrame,
    users: DataFrame,
    user_id: int | None = None,
    username: str | None = None,
    active: bool | None = None,
    limit: int = 100,
    offset: int = 0,
) -> DataFrame:
    """A page of sessions, newest first, with usernames and the ``total`` of matches.

    The page is cut before the join, so at most ``limit`` rows look up a name.
    """
    if user_id is not None:
        sessions = sessions.where(F.col("user_id") == int(user_id))
    if username:
        wanted = users.where(F.col("username") == username.strip().lower()).select(F.col("id").alias("user_id"))
        sessions = sessions.join(wanted, "user_id", "left_semi")
    if active is not None:
        sessions = sessions.where(F.col("is_active") == bool(active))
    total = sessions.agg(F.count("*")).scalar()
    newest = [F.desc("created_at"), F.desc("session_token")]
    page = sessions.orderBy(*newest).offset(max(0, offset)).limit(at_least_one(limit))
    # Users are cut to those of the page; Spark broadcasts what measures small.
    ids = page.select(F.col("user_id").alias("id")).distinct()
    names = users.select("id", "username").join(ids, "id", "left_semi")
    named = page.join(names.withColumnRenamed("id", "user_id"), "user_id", "left")
    return named.withColumn("total", total).orderBy(*newest)


def active_user_ids(sessions: DataFrame) -> DataFrame:
    return sessions.where(F.col("is_active") & F.col("user_id").isNotNull()).select("user_id").distinct()


def user_status(users: DataFrame, sessions: DataFrame) -> DataFrame:
    """Users as Disabled, Online (some active session) or Offline."""
    online = active_user_ids(sessions).select(F.col("user_id").alias("id"), F.lit(True).alias("online"))
    status = (
        F.when(~F.coalesce(F.col("is_active"), F.lit(True)), F.lit("Disabled"))
        .when(F.col("online"), F.lit("Online"))
        .otherwise(F.lit("Offline"))
    )
    return users.join(online, "id", "left").withColumn("status", status).drop("online")


def users_online(users: DataFrame, sessions: DataFrame) -> DataFrame:
    enabled = users.where(F.coalesce(F.col("is_active"), F.lit(True)))
    return enabled.join(active_user_ids(sessions).withColumnRenamed("user_id", "id"), "id", "left_semi")


def users_offline(users: DataFrame, sessions: DataFrame) -> DataFrame:
    enabled = users.where(F.coalesce(F.col("is_active"), F.lit(True)))
    return enabled.join(active_user_ids(sessions).withColumnRenamed("user_id", "id"), "id", "left_anti")


def account_kpis(users: DataFrame, sessions: DataFrame) -> DataFrame:
    """Users, active sessions, users with an active session, and analysts, in one row.

    A user counts as active when the session's user is known.
    """
    active = F.col("is_active")
    people = users.agg(
        F.count("*").alias("total_users"), F.count_if(F.lower("role") == "analyst").alias("analysts")
    )
    open_sessions = sessions.agg(F.count_if(active).alias("active_sessions"))
    known = users.select(F.col("id").alias("user_id")).join(active_user_ids(sessions), "user_id", "left_semi")
    return people.select(
        "total_users",
        open_sessions.scalar().alias("active_sessions"),
        known.agg(F.count("*")).scalar().alias("active_users"),
        "analysts",
    )


def last_login(sessions: DataFrame) -> DataFrame:
    """Latest session start per user; the expiry stands in for a missing start."""
    return (
        sessions.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.max(F.coalesce("created_at", "expires_at")).alias("last_login"))
    )
