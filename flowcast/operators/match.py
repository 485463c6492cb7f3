"""Match documents to relational tables."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowcast.operators.nested import at, explode_rows, map_rows, project, tagged_rows
from flowcast.sources.readers import read_json
from flowcast.sources.releases import save_release
from flowcast.sources.staging import stage
from flowcast.sources.writers import save_table

# The match document. Objects keyed by a name are maps, so any team
# and player names fit and absent optional keys read as NULL.
MATCH_SCHEMA = """
meta struct<data_version:string, created:string, revision:int>,
info struct<
  city:string, dates:array<string>, gender:string, match_type:string,
  match_type_number:int, season:string, team_type:string, venue:string,
  teams:array<string>,
  event:struct<name:string, match_number:int, `group`:string>,
  toss:struct<winner:string, decision:string>,
  outcome:struct<winner:string, `by`:struct<runs:int>>,
  officials:struct<match_referees:array<string>, reserve_umpires:array<string>,
    umpires:array<string>>,
  players:map<string,array<string>>,
  registry:struct<people:map<string,string>>>,
innings array<struct<team:string,
  overs:array<struct<`over`:int,
    deliveries:array<struct<batter:string, bowler:string, non_striker:string,
      runs:struct<batter:int, extras:int, total:int>,
      wickets:array<struct<player_out:string, kind:string>>>>>>>>
"""

# Output columns and the paths they come from.
METADATA = {
    "data_version": "meta.data_version",
    "created": "meta.created",
    "revision": "meta.revision",
}
MATCH_INFO = {
    "city": "info.city",
    "match_date": "info.dates[0]",
    "event_name": "info.event.name",
    "match_number": "info.event.match_number",
    "group": "info.event.group",
    "gender": "info.gender",
    "match_type": "info.match_type",
    "match_type_number": "info.match_type_number",
    "season": "info.season",
    "team_type": "info.team_type",
    "venue": "info.venue",
    "toss_winner": "info.toss.winner",
    "toss_decision": "info.toss.decision",
    "winner": "info.outcome.winner",
    "win_by_runs": "info.outcome.by.runs",
}
MATCH_HEADER = {
    "Match_Type": "info.match_type",
    "Date": "info.dates[0]",
    "Venue": "info.venue",
    "Team1": "info.teams[0]",
    "Team2": "info.teams[1]",
    "Winner": "info.outcome.winner",
}
ROLES = {
    "match_referee": "info.officials.match_referees",
    "reserve_umpire": "info.officials.reserve_umpires",
    "umpire": "info.officials.umpires",
}
DELIVERY = {
    "Batter": "delivery.batter",
    "Bowler": "delivery.bowler",
    "Non_Striker": "delivery.non_striker",
    "Runs_Batter": "delivery.runs.batter",
    "Runs_Extras": "delivery.runs.extras",
    "Runs_Total": "delivery.runs.total",
}


def read_matches(spark, path, schema=MATCH_SCHEMA, multiline=True, key="match_id"):
    """Match documents, one per file, keyed by the file name."""
    return read_json(spark, path, schema, multiline, file_key=key)


def objects_schema(*names):
    """The match schema narrowed to some of its top-level objects."""
    whole = T.StructType.fromDDL(MATCH_SCHEMA)
    return T.StructType([f for f in whole.fields if f.name in names])


def metadata(docs, key="match_id"):
    return project(docs, METADATA, keep=[key])


def match_info(docs, key="match_id"):
    return project(docs, MATCH_INFO, keep=[key])


def match_header(docs, key="match_id"):
    return project(docs, MATCH_HEADER, keep=[key])


def officials(docs, key="match_id"):
    """(official_name, role) rows; a role nobody holds has none."""
    return tagged_rows(docs, ROLES, "official_name", "role", keep=[key])


def players(docs, key="match_id"):
    """(player_name, team_name) rows for whatever teams a document names."""
    teams = map_rows(docs, "info.players", "team_name", "names", keep=[key])
    return explode_rows(teams, "names", "player_name", keep=[key, "team_name"])


def registry(docs, key="match_id"):
    return map_rows(docs, "info.registry.people", "player_name", "player_id", keep=[key])


def deliveries(docs, key="match_id", header=()):
    """One row per delivery with its team, over and positions; parents are carried."""
    innings = explode_rows(docs, "innings", "inning", [key, *header], position="inning_no")
    overs = explode_rows(
        innings.select("*", at("inning.team").alias("Team")), "inning.overs", "over_data",
        [key, *header, "inning_no", "Team"],
    )
    return explode_rows(
        overs.select("*", at("over_data.over").alias("Over")), "over_data.deliveries", "delivery",
        [key, *header, "inning_no", "Team", "Over"], position="ball_no",
    )


def ball_by_ball(docs, key="match_id"):
    """The 13 delivery columns; a wicket pair is the first of its delivery.

    Scan, three generators and a projection: no shuffle, and document values stay
    with their document.
    """
    headed = docs.select(
        "innings", F.col(key).alias("Match_ID"), at("info.dates[0]").alias("Date"),
        at("info.venue").alias("Venue"),
    )
    balls = deliveries(headed, "Match_ID", ["Date", "Venue"])
    return balls.select(
        "Match_ID", "Date", "Venue", "Team", "Over",
        *[at(path).alias(name) for name, path in DELIVERY.items()],
        F.get(at("delivery.wickets.player_out"), F.lit(0)).alias("Wicket_Player_Out"),
        F.get(at("delivery.wickets.kind"), F.lit(0)).alias("Wicket_Kind"),
    )


def wickets(docs, key="match_id"):
    """Every wicket, also the second of a delivery."""
    balls = deliveries(docs, key)
    rows = explode_rows(
        balls, "delivery.wickets", "wicket", [key, "inning_no", "Team", "Over", "ball_no"]
    )
    return rows.select(
        key, "inning_no", "Team", "Over", "ball_no", at("wicket.player_out").alias("player_out"),
        at("wicket.kind").alias("kind"),
    )


# Table names.
TABLES = {
    "metadata_table": metadata,
    "match_information_table": match_info,
    "officials_table": officials,
    "players_table": players,
    "registry_table": registry,
}


def match_tables(docs, key="match_id", staged=True):
    """The five tables by name. Staging parses the JSON once; each table then reads
    only the nested columns it needs."""
    docs = stage(docs.select(key, "meta", "info"), "matches") if staged else docs
    return {name: make(docs, key) for name, make in TABLES.items()}


def save_match_tables(docs, key="match_id", fmt="parquet", mode="error", prefix="", path=None):
    """Write the five tables to the catalog."""
    return {
        name: save_table(table, prefix + name, fmt, mode, path and f"{path}/{name}")
        for name, table in match_tables(docs, key).items()
    }


def save_match_release(docs, root, release, key="match_id", fmt="parquet"):
    """Save the five tables together: readers see all of a release or all of the one before it."""
    return save_release(match_tables(docs, key), root, release, fmt)
