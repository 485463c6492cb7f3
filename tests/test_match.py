import json

import pytest

from flowcast.operators import match as mt

FULL = {
    "meta": {"data_version": "1.1.0", "created": "2023-10-01", "revision": 2},
    "info": {
        "city": "Hilltown", "dates": ["2023-09-30", "2023-10-01"], "gender": "male",
        "match_type": "T20", "match_type_number": 7, "season": "2023/24",
        "team_type": "international", "venue": "Park Road", "teams": ["North Hill", "Lakeside"],
        "event": {"name": "Series", "match_number": 3, "group": "B"},
        "toss": {"winner": "Lakeside", "decision": "field"},
        "outcome": {"winner": "North Hill", "by": {"runs": 12}},
        "officials": {"match_referees": ["R1"], "reserve_umpires": ["V1"], "umpires": ["U1", "U2"]},
        "players": {"North Hill": ["A", "B"], "Lakeside": ["C"]},
        "registry": {"people": {"A": "a1", "C": "c1"}}},
    "innings": [
        {"team": "North Hill", "overs": [
            {"over": 0, "deliveries": [
                {"batter": "A", "bowler": "C", "non_striker": "B",
                 "runs": {"batter": 4, "extras": 0, "total": 4}},
                {"batter": "A", "bowler": "C", "non_striker": "B",
                 "runs": {"batter": 0, "extras": 1, "total": 1}, "wickets": []},
                {"batter": "B", "bowler": "C", "non_striker": "A",
                 "runs": {"batter": 0, "extras": 0, "total": 0},
                 "wickets": [{"player_out": "B", "kind": "bowled"},
                             {"player_out": "A", "kind": "run out"}]}]},
            {"over": 1, "deliveries": []}]},
        {"team": "Lakeside", "overs": [{"over": 0, "deliveries": [
            {"batter": "C", "bowler": "A", "non_striker": "D",
             "runs": {"batter": 1, "extras": 0, "total": 1},
             "wickets": [{"player_out": "C", "kind": "caught"}]}]}]}]}
BARE = {
    "meta": {"data_version": "1.0.0"},
    "info": {"dates": ["2024-02-02"], "venue": "Elsewhere", "teams": ["X", "Y Z"],
             "outcome": {"winner": "X"}, "officials": {"umpires": ["U9"]},
             "players": {"Y Z": ["Q"]}},
    "innings": [{"team": "X", "overs": [{"over": 4, "deliveries": [
        {"batter": "P", "bowler": "Q", "non_striker": "S",
         "runs": {"batter": 6, "extras": 0, "total": 6}}]}]}]}


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("matches")
    (folder / "100-1.json").write_text(json.dumps(FULL, indent=2))
    (folder / "200.json").write_text(json.dumps(BARE, indent=2))
    return mt.read_matches(spark, str(folder))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or ["*"])).collect()), key=repr)


def test_header_tables(docs):
    assert rows(mt.metadata(docs)) == [("100-1", "1.1.0", "2023-10-01", 2), ("200", "1.0.0", None, None)]
    info = {r.match_id: r for r in mt.match_info(docs).collect()}
    assert len(mt.match_info(docs).columns) == 16
    assert tuple(info["100-1"])[1:] == (
        "Hilltown", "2023-09-30", "Series", 3, "B", "male", "T20", 7, "2023/24", "international",
        "Park Road", "Lakeside", "field", "North Hill", 12)
    assert (info["200"].win_by_runs, info["200"].group, info["200"].winner) == (None, None, "X")
    assert rows(mt.match_header(docs), "match_id", "Team1", "Team2") == [
        ("100-1", "North Hill", "Lakeside"), ("200", "X", "Y Z")]


def test_officials_players_registry(docs):
    assert rows(mt.officials(docs)) == [
        ("100-1", "R1", "match_referee"), ("100-1", "U1", "umpire"), ("100-1", "U2", "umpire"),
        ("100-1", "V1", "reserve_umpire"), ("200", "U9", "umpire")]
    assert rows(mt.players(docs), "match_id", "team_name", "player_name") == [
        ("100-1", "Lakeside", "C"), ("100-1", "North Hill", "A"), ("100-1", "North Hill", "B"),
        ("200", "Y Z", "Q")]
    assert rows(mt.registry(docs)) == [("100-1", "A", "a1"), ("100-1", "C", "c1")]


def test_ball_by_ball(docs):
    out = mt.ball_by_ball(docs)
    assert out.columns == [
        "Match_ID", "Date", "Venue", "Team", "Over", "Batter", "Bowler", "Non_Striker",
        "Runs_Batter", "Runs_Extras", "Runs_Total", "Wicket_Player_Out", "Wicket_Kind"]
    got = rows(out, "Match_ID", "Venue", "Team", "Over", "Runs_Total", "Wicket_Player_Out", "Wicket_Kind")
    assert got == [
        ("100-1", "Park Road", "Lakeside", 0, 1, "C", "caught"),
        ("100-1", "Park Road", "North Hill", 0, 0, "B", "bowled"),
        ("100-1", "Park Road", "North Hill", 0, 1, None, None),
        ("100-1", "Park Road", "North Hill", 0, 4, None, None),
        ("200", "Elsewhere", "X", 4, 6, None, None)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_every_wicket(docs):
    got = rows(mt.wickets(docs), "match_id", "Team", "ball_no", "player_out", "kind")
    assert got == [("100-1", "Lakeside", 0, "C", "caught"), ("100-1", "North Hill", 2, "A", "run out"),
                   ("100-1", "North Hill", 2, "B", "bowled")]


def test_tables_are_saved_once(spark, docs, tmp_path):
    saved = mt.save_match_tables(docs, prefix="t1_", path=str(tmp_path))
    assert {n: t.count() for n, t in saved.items()} == {
        "metadata_table": 2, "match_information_table": 2, "officials_table": 5,
        "players_table": 4, "registry_table": 2}
    with pytest.raises(Exception, match="already exists"):
        mt.save_match_tables(docs, prefix="t1_", path=str(tmp_path))
    again = mt.save_match_tables(docs, prefix="t1_", path=str(tmp_path), mode="overwrite")
    assert again["players_table"].count() == 4


def test_files_of_a_day_hold_every_order(spark, tmp_path):
    from flowcast.queries import nesting
    spark.sql("""SELECT id AS o_orderkey, id % 30 AS o_custkey, date_add(DATE '2024-01-30', CAST(id % 5 AS INT)) AS o_orderdate,
        'p' || id % 3 AS o_orderpriority, 'F' AS o_orderstatus, 1000.0D AS o_totalprice FROM range(200)""").write.parquet(f"{tmp_path}/orders.parquet")
    got = nesting.QUERIES["match_day_files"](spark, str(tmp_path)).collect()
    want = [(f"2024-{'01' if i % 5 < 2 else '02'}-{[30, 31, 1, 2, 3][i % 5]:02}", f"p{i % 3}", f"Ground {i % 10}") for i in range(200)]
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_files_of_a_day_grow_with_its_orders_alone(spark, tmp_path):
    """One file per day however its orders are spread over the input; days of many orders in several."""
    from flowcast.queries import documents
    spark.sql("""SELECT id AS o_orderkey, id % 30 AS o_custkey, IF(id % 5 < 4, date_add(DATE '2024-01-30', CAST(id % 5 AS INT)), NULL) AS o_orderdate,
        'p' AS o_orderpriority, 'F' AS o_orderstatus, 1000.0D AS o_totalprice FROM range(400)""").repartition(8).write.parquet(f"{tmp_path}/orders.parquet")
    for bits, most in ((16, 5), (5, 15)):
        texts = [json.loads(r.value) for r in documents.day_documents(spark, str(tmp_path), bits=bits).collect()]
        assert 5 <= len(texts) <= most and (bits == 16 or len(texts) > 5)
        assert sum(map(len, texts)) == 400
        assert all(len({d["meta"].get("created") for d in text}) == 1 for text in texts)
        assert sorted(d["info"]["event"]["match_number"] for text in texts for d in text) == sorted(i % 100 for i in range(400))


def test_innings_of_an_order_are_one_document_wherever_its_lines_lie(spark, tmp_path):
    """Only an order of more lines than a run has several documents; lines are shuffled as narrow columns, once."""
    from flowcast.queries import documents
    spark.sql("""SELECT IF(id < 70000, 0, id % 50) AS l_orderkey, id AS l_partkey, id % 9 AS l_suppkey, CAST(id % 7 AS INT) AS l_linenumber,
        CAST(id % 50 AS DOUBLE) AS l_quantity, 0.04D AS l_discount, 10.5D AS l_extendedprice, IF(id % 2 = 0, 'A', 'N') AS l_returnflag,
        IF(id % 3 = 0, 'F', 'O') AS l_linestatus, TIMESTAMP_NTZ '2024-01-30 23:00:00' AS l_shipdate FROM range(71000)
        """).repartition(5).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("SELECT id AS o_orderkey, DATE '2024-01-30' AS o_orderdate, 'p' || id AS o_orderpriority FROM range(60)").write.parquet(f"{tmp_path}/orders.parquet")
    docs = documents.innings_documents(spark, str(tmp_path))
    sizes = dict(docs.groupBy("match_id").count().collect())
    assert sizes.pop("0") == 2 and set(sizes.values()) == {1} and len(sizes) == 49
    balls = mt.ball_by_ball(docs)
    got = balls.selectExpr("count(*)", "count(distinct Batter)", "count(Wicket_Kind)", "count_if(Venue <> 'p' || Match_ID)", "sum(Runs_Batter)").first()
    assert tuple(got) == (71000, 71000, 23667, 0, sum(i % 50 for i in range(71000)))
    assert {(r.Non_Striker, r.Runs_Extras, r.Runs_Total) for r in balls.select("Non_Striker", "Runs_Extras", "Runs_Total").distinct().collect()} == {("2024-01-30", 4, 10)}
