"""Expression functions, CSV sources/sinks, ingest steps and HTML extraction on small inputs."""

import os

import pytest
from pyspark.sql import functions as F

from touchline.functions import text as X
from touchline.operators import extract as E
from touchline.operators import ingest as R
from touchline.sources import csv_tables as S


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr("s").alias("v")).collect()[0]["v"]


def test_text_helpers(spark):
    assert one(spark, X.normalize_score, "  2–1 ") == "2-1"
    assert one(spark, X.normalize_score, "  ") is None
    assert one(spark, X.match_id_from_url, "https://x/en/matches/2382ecc0/A-B") == "2382ecc0"
    assert one(spark, X.match_id_from_url, "https://x/en/squads/1/") is None
    assert one(spark, X.player_id_from_url, "https://x/en/players/ca885102/Val-Noel") == "ca885102"
    assert one(spark, X.name_from_slug, "https://x/en/players/55975b0c/Valentin-Noel") == "Valentin Noel"
    assert one(spark, X.name_from_slug, "https://x/en/players/55975b0c") is None
    assert one(spark, X.nationality_code, "us USA") == "USA"
    assert one(spark, X.nationality_code, "mx") == "mx"
    assert one(spark, X.nationality_code, "  ") is None
    assert one(spark, X.primary_position, "DF,MF") == "DF"
    assert one(spark, X.primary_position, "FW") == "FW"
    assert one(spark, X.notes_skip, "Match awarded to A") is True
    assert one(spark, X.notes_skip, None) is False
    assert one(spark, X.age_numeric, "19-302") == 19 + 302 / 365
    assert one(spark, X.age_numeric, "0") is None
    assert one(spark, X.numeric_or_zero, "n/a") == 0.0
    assert one(spark, X.spreadsheet_safe, "2-1") == "'2-1"
    assert one(spark, X.spreadsheet_safe, "nan") == ""
    assert str(one(spark, X.try_parse_date, "03/29/2017")) == "2017-03-29"
    assert one(spark, X.try_parse_date, "TBD") is None
    assert one(spark, X.surrogate_key, None) == one(spark, lambda c: F.md5(F.lit(X.SURROGATE_NULL)), None)


def test_score_parser(spark):
    df = spark.createDataFrame([("(4) 1-1 (2)",), ("2-0",), (None,)], "s string")
    out = df.select(*[v.alias(k) for k, v in X.parse_score("s").items()]).collect()
    assert tuple(out[0]) == (4, 1, 1, 2)
    assert tuple(out[1]) == (None, 2, 0, None)
    assert tuple(out[2]) == (None, None, None, None)


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_union_by_name_and_alias(spark, tmp_dir):
    d = os.path.join(tmp_dir, "players")
    write(f"{d}/a.csv", '"player_id","match_id","tackles_won","goals"\n"32428e51","m1","2","1"\n')
    write(f"{d}/b.csv", 'match_id,goals,player_id,tackles_wom\nm2,0,p2,5\nm3,,p3,\n')
    write(f"{d}/c.csv", "gk_saves,gk_save_pct\n")  # header only: an empty day
    df = S.read_csv_by_name(spark, d, ["player_id", "match_id", "goals", "tackles_won", "lineup_status"])
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [("32428e51", "m1", "1", "2", None), ("p2", "m2", "0", "5", None), ("p3", "m3", None, None, None)]


def test_repair_report(spark, tmp_dir):
    d = os.path.join(tmp_dir, "rep")
    write(f"{d}/a.csv", "x,tackles_wom\n1,2\n")
    write(f"{d}/b.csv", "x,tackles_won\n1,2\n")
    write(f"{d}/c.csv", "x,tackles_won\n1,caf\ufffd\n")  # a replacement character of its own is no error
    with open(f"{d}/d.csv", "wb") as f:
        f.write(b"x,tackles_wom\n1,caf\xe9\n")
    report = S.header_repair_report(spark, d)
    rep = {os.path.basename(r["file"]): (r["occurrences"], r["not_utf8"]) for r in report.collect()}
    assert rep == {"a.csv": (1, False), "b.csv": (0, False), "c.csv": (0, False), "d.csv": (None, True)}
    assert tuple(S.header_repair_totals(report).first()) == (4, 1, 1, 1)


def test_partitioned_sink_and_guarded_overwrite(spark, tmp_dir):
    path = os.path.join(tmp_dir, "matches")
    df = spark.createDataFrame([("73_2020", "m1"), ("73_2021", "m2")], "season_id string, match_id string")
    S.write_partitioned(df, path, ["season_id"], fmt="parquet")
    refresh = spark.createDataFrame([("73_2021", "m3"), ("73_2021", "m4")], "season_id string, match_id string")
    R.overwrite_season(refresh, path)
    R.overwrite_season(refresh.limit(0), path)                       # an empty refresh writes nothing
    got = sorted(tuple(r) for r in S.read_partitioned(spark, path, fmt="parquet").select("season_id", "match_id").collect())
    assert got == [("73_2020", "m1"), ("73_2021", "m3"), ("73_2021", "m4")]


def test_season_dims_and_lookup(spark):
    years = spark.createDataFrame([("2025",), ("2026",)], "season_year_id string")
    dims = S.season_dims(years, {"73": "L"}, base_url="https://h")
    r = {x["season_id"]: x for x in dims.collect()}
    assert r["73_2026"]["url"] == "https://h/en/comps/73/2026/schedule/" and r["73_2026"]["season_name"] == "2026 Season"
    req = spark.createDataFrame([("73_2026",), ("73_2027",)], "season_id string")
    got = {x["season_id"]: x["source"] for x in R.schedule_lookup(req, dims, base_url="https://h").collect()}
    assert got == {"73_2026": "file", "73_2027": "synthesised"}


def test_missing_dates_anti_join(spark):
    m = spark.createDataFrame([("73_2026", "2026-03-07"), ("73_2026", "2026-03-14"), ("73_2026", "bad")],
                              "season_id string, date string")
    files = spark.createDataFrame([("73_2026", "/p/player_match_data_73_2026_2026-03-07.csv")],
                                  "season_id string, path string")
    got = sorted(r["date"] for r in R.missing_date_list(m, R.stored_dates(files)).collect())
    assert got == ["2026-03-14", "bad"]
    assert R.missing_date_list(m, R.stored_dates(files.limit(0))).count() == 3


SCHEDULE_PAGE = """<div id="all_sched"><div class="table_container"><table class="stats_table">
<tbody><tr class="thead"><th>Date</th></tr>
<tr data-row="0"><th data-stat="round"><a href="/r">Final</a></th><td data-stat="date">2021-10-08</td>
<td data-stat="start_time"><span class="venuetime">19:30</span></td><td data-stat="home_team">A</td>
<td data-stat="score"><a href="/en/matches/abc/A-B">(3) 2&ndash;2 (5)</a></td><td data-stat="away_team">B</td>
<td data-stat="match_report"><a href="/en/matches/abc/A-B">Match Report</a></td><td data-stat="notes"></td></tr>
<tr data-row="0"><td data-stat="date">2021-10-08</td><td data-stat="home_team">dup</td></tr>
<tr><td data-stat="date">2099-01-01</td><td data-stat="home_team">future</td></tr>
</tbody></table></div></div>"""


def test_schedule_extraction_fallback_dedup_and_future(spark):
    pages = spark.createDataFrame([(1, "u", SCHEDULE_PAGE, "73_2021")], "page_id long, url string, html string, season_id string")
    rows = E.schedule_rows(pages, as_of="2026-01-01", base_url="https://x").collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["round"], r["start_time"], r["home_team"], r["score"]) == ("Final", "19:30", "A", "(3) 2-2 (5)")
    assert (r["home_score"], r["away_score"], r["match_id"]) == ("(3) 2", "2 (5)", "abc")
    assert r["match_report"] == "https://x/en/matches/abc/A-B" and r["notes"] is None


MATCH_PAGE = """<div id="all_player_stats_1"><div class="table_container"><table class="stats_table">
<caption>Team A  Player Stats Table</caption><tbody>
<tr><th data-stat="player"><a href="/en/players/aa11/Ann-Bee">Ann Bee</a></th><td data-stat="nationality">us USA</td>
<td data-stat="position">DF,MF</td><td data-stat="minutes">90</td><td data-stat="goals"></td></tr>
<tr><th data-stat="player">&nbsp;&nbsp;&nbsp;Cy Dee</th><td data-stat="position">FW</td></tr>
</tbody></table></div></div>
<div id="all_keeper_stats_1"><div class="table_container"><table class="stats_table">
<caption>Team A Goalkeeper Stats Table</caption><tbody>
<tr><th data-stat="player"><a href="/en/players/aa11/Ann-Bee">Ann Bee</a></th><td data-stat="gk_saves">4</td>
<td data-stat="gk_save_pct">-</td></tr></tbody></table></div></div>"""


def test_player_extraction_and_keeper_merge(spark):
    pages = spark.createDataFrame([(1, "https://x/en/matches/m9/A-B", MATCH_PAGE)], "page_id long, url string, html string")
    rows = {r["player"]: r for r in E.player_match_rows(pages, base_url="https://x").collect()}
    a, c = rows["Ann Bee"], rows["Cy Dee"]
    assert (a["team_name"], a["player_id"], a["match_id"], a["nationality"]) == ("Team A", "aa11", "m9", "USA")
    assert (a["primary_position"], a["minutes"], a["goals"], a["lineup_status"]) == ("DF", 90, 0, "Starter")
    assert (a["gk_saves"], a["gk_save_pct"]) == (4.0, 0.0)
    assert (c["player_id"], c["lineup_status"], c["minutes"], c["nationality"]) == (None, "Sub", 0, None)
    assert c["gk_saves"] == 0.0


def test_season_dims_loader_fills_missing_columns(spark, tmp_dir):
    d = os.path.join(tmp_dir, "season_dims")
    write(f"{d}/season_data_73_2021.csv",
          "season_id,league_id,league_name,season_year_id,season_name,url\n73_2021,73,L,2021,2021 Season,https://h/s\n")
    write(f"{d}/season_data_73_2022.csv", '"season_id","url","extra"\n"73_2022","https://h/t","x"\n')
    rows = sorted((tuple(r) for r in S.load_season_dims(spark, d).collect()), key=lambda t: t[2])
    assert rows == [("73", "L", "73_2021", "2021 Season", "https://h/s"), (None, None, "73_2022", None, "https://h/t")]


def test_sort_by_season_date_nulls_last(spark):
    df = spark.createDataFrame([("73_2021", "2021-05-01", "b"), ("73_2021", "bad", "a"), ("73_2021", "2021-04-01", "c"),
                                ("73_2020", "2020-09-09", "d")], "season_id string, date string, u string")
    got = [r["u"] for r in R.sort_by_season_date(df, tiebreak=["u"]).collect()]
    assert got == ["d", "c", "b", "a"]


def page(spark, html):
    return spark.createDataFrame([(1, "https://x/en/matches/m9/A-B", html, "73_2021")], "page_id long, url string, html string, season_id string")


def player_table(team, *names):
    rows = "".join(f"<tr><th data-stat='player'>{n}</th></tr>" for n in names)
    return f"<table class='stats_table'><caption>{team} Player Stats Table</caption><tbody>{rows}</tbody></table>"


def test_all_tables_inside_a_container_and_none_outside(spark):
    html = (f"{player_table('Z', 'outside')}<div id='all_player_stats_1'><div>{player_table('A', 'a1')}</div>{player_table('B', 'b1', 'b2')}</div>"
            f"<div id='all_player_stats_2'></div><!-- <div id='all_player_stats_3'>{player_table('C', 'hidden')}</div> -->"
            f"<div id='all_keeper_stats_1'>{player_table('A', 'keeper')}</div>")
    rows = {(r["team_name"], r["player"]) for r in E.player_match_rows(page(spark, html)).collect()}
    assert rows == {("A", "a1"), ("B", "b1"), ("B", "b2")}


def test_schedule_container_quotes_references_and_dates(spark):
    def row(date, home, score):
        return f"<tr><td data-stat='date'>{date}</td><td data-stat='home_team'>{home}</td><td data-stat='score'>{score}</td></tr>"

    rows = row("Mar 7, 2021", "Jos&eacute;", "2&#8211;1") + row("07-03-2021", "Ren&#233;", "0&ndash;0") + row("20210307", "A&amp;B", "1-1") + row("Mar 7, 2099", "later", "")
    table = f"<table class='x stats_table y'><tbody>{rows}</tbody></table>"
    html = f"<div id='switcher_sched'>{table}</div>{table.replace('2021', '2020')}"
    got = sorted((r["home_team"], r["score"], r["home_score"]) for r in E.schedule_rows(page(spark, html), as_of="2026-01-01").collect())
    assert got == [("A&B", "1-1", "1"), ("José", "2-1", "2"), ("René", "0-0", "0")]


def test_keepers_stay_in_their_match(spark):
    s = "player_id string, match_id string"
    of = spark.createDataFrame([(None, None), (None, None), (None, "m1"), ("p", "m1"), ("p", "m2"), ("p", None)], s)
    k = spark.createDataFrame([(None, None, "9"), (None, "m1", "1"), ("p", "m1", "2"), ("p", None, "8")], s + ", gk_saves string")
    got = sorted((str(r["player_id"]), str(r["match_id"]), r["gk_saves"]) for r in R.keeper_merge(of, k).collect())
    assert got == [("None", "None", 0.0), ("None", "None", 0.0), ("None", "m1", 1.0), ("p", "None", 0.0), ("p", "m1", 2.0), ("p", "m2", 0.0)]


def test_start_dates(spark):
    df = spark.createDataFrame([("2021-03-01",), ("Mar 9, 2021",), ("x",)], "date string")
    for start in ("2021-03-07", "Mar 7, 2021", "20210307", "7 March 2021"):
        assert [r["date"] for r in R.start_date_filter(df, start).collect()] == ["Mar 9, 2021"]
    with pytest.warns(UserWarning):
        assert R.start_date_filter(df, "soon").count() == 3


def test_positions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("id")).repartition(7)
    got = {r["id"]: r["position"] for r in R.positions(df.orderBy("id")).collect()}
    assert got == {i: i + 1 for i in range(1000)}


def names_and_minutes(spark, html):
    return [(r["player"], r["minutes"]) for r in E.player_match_rows(page(spark, html)).collect()]


@pytest.mark.parametrize("html", [
    "<div id=all_player_stats_1><table class=stats_table><tbody><tr><th data-stat=player>Ann</th><td data-stat=minutes>90</td></tr></tbody></table></div>",
    "<DIV ID='all_player_stats_1'><TABLE CLASS='x stats_table'><TBODY><TR><TH DATA-STAT='player'>Ann</TH><TD DATA-STAT='minutes'>90</TD></TR></TBODY></TABLE></DIV>",
    '<div id="all_player_stats_1"><table class="stats_table"><thead><tr><th>x<tbody><tr><th data-stat="player">Ann<td data-stat="minutes">90<tr class="thead"><th data-stat="player">Player</table></div>',
    '<div id="all_player_stats_1"><table class="stats_table"><tr><th title="a>b" data-stat="player" data-x=\'"\'>Ann</th><td data-stat = "minutes">90</td></tr></table>',
    '<div id="all_player_stats_1"><table class="stats_table"><tbody><tr><th data-stat="player"><div><b>A</b>nn</div></th><td data-stat="minutes"><table><tr><td>9</td></tr></table>0</td><td data-stat="minutes">1</td></tr></table></div>',
    '<script>var x = "<div id=all_player_stats_0><table class=stats_table><tr><th data-stat=player>No"</script><div id="all_player_stats_1"><table class="stats_table"><!-- <tr><th data-stat="player">No --><tr><th data-stat="player">A<!-- x -->nn</th><td data-stat="minutes">90',
])
def test_liberties_of_html(spark, html):
    """Quotes or none, either case, end tags left out, > in an attribute, nested tables, comments and scripts."""
    assert names_and_minutes(spark, html) == [("Ann", 90)]


def test_character_references(spark):
    html = "<div id='all_player_stats_1'>" + player_table("T &amp; U", "O&apos;Brien", "Ko&ccaron;a", "A&eacuteB", "&#150;x&#x96;", "&nosuch;", "&#0;y") + "</div>"
    rows = E.player_match_rows(page(spark, html)).collect()
    assert [r["player"] for r in rows] == ["O'Brien", "Ko\u010da", "A\u00e9B", "\u2013x\u2013", "&nosuch;", "\ufffdy"]
    assert {r["team_name"] for r in rows} == {"T & U"}


def test_page_is_read_in_linear_time(spark):
    import time

    row = "<tr><th data-stat='player'><div><a href='/en/players/p1/A-B'>x</a></div></th><td data-stat='minutes'>1</td></tr>"
    html = "<div id='all_player_stats_1'>" + "<div>" * 20_000 + "</div>" * 20_000 + f"<table class='stats_table'><tbody>{row * 20_000}</tbody></table></div>"
    t = time.time()
    assert E.outfield_rows(page(spark, html)).count() == 20_000
    assert time.time() - t < 60


def test_first_accepted_row_of_a_data_row(spark):
    """X4 after X5 and X6: an empty or coming match does not hide a later row; places and tables in order; rows without id stay."""
    def row(i, date, home):
        return f"<tr data-row='{i}'><td data-stat='date'>{date}</td><td data-stat='home_team'>{home}</td></tr>"

    rows = row(1, "2999-01-01", "later") + row(1, "2021-01-01", "a") + row(1, "2021-01-02", "b") + row(2, "", "") + row(2, "2021-01-03", "c") + "<tr><td data-stat='date'>2021-01-04</td></tr>" * 2
    table = f"<table class='stats_table'><tbody>{rows}</tbody><tbody>{row(1, '2021-01-05', 'd')}</tbody></table>"
    got = E.schedule_rows(page(spark, f"<div id='all_sched'>{table}{table}</div>"), as_of="2026-01-01").collect()
    assert sorted((r["date"], r["home_team"]) for r in got) == [("2021-01-01", "a"), ("2021-01-03", "c")] + [("2021-01-04", None)] * 4


def test_keepers_of_the_same_page(spark):
    """R1 in the page: a player with two keeper rows is there twice, those without link find the keepers without link."""
    def row(name, link, more=""):
        who = f"<a href='/en/players/{link}/x'>{name}</a>" if link else name
        return f"<tr><th data-stat='player'>{who}</th>{more}</tr>"

    def table(kind, rows):
        return f"<div id='all_{kind}_stats_1'><table class='stats_table'><tbody>{rows}</tbody></table></div>"

    saves = "<td data-stat='gk_saves'>{}</td>"
    html = table("player", row("A", "a1") + row("B", None) + row("C", "c1")) + table("keeper", row("A", "a1", saves.format(3)) + row("A", "a1", saves.format("x")) + row("K", None, saves.format(5)))
    got = sorted((r["player_id"] or "", r["gk_saves"]) for r in E.player_match_rows(page(spark, html)).collect())
    assert got == [("", 5.0), ("a1", 0.0), ("a1", 3.0), ("c1", 0.0)]
    other = page(spark, html).withColumn("url", F.lit("https://x/none"))
    assert {r["gk_saves"] for r in E.player_match_rows(other).collect()} == {0.0}


def test_numbers_of_a_hot_key(spark):
    """Half of the rows have one (null) key: numbered in order, and no partition of the sort holds more than its share."""
    df = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 97).alias("k"), (F.col("id") * 7919 % 40_009).alias("x"))
    rows = R.numbered(df.repartition(8), ["k"], ["x"], "n")
    want = df.selectExpr("k", "x", "row_number() over (partition by k order by x) as n")
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    parts = df.repartitionByRange(8, "k", "x").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) < 3 * 40_000 / 8


def test_join_of_groups_with_a_hot_and_a_null_key(spark):
    from touchline.operators.keys import join_unique

    rows = spark.range(3000).select(F.when(F.col("id") > 1000, F.lit("h")).when(F.col("id") > 500, F.col("id").cast("string")).alias("k"), (F.col("id") % 3).alias("j"))
    groups = rows.groupBy("k", "j").agg(F.count(F.lit(1)).alias("n"), F.concat_ws("-", F.first("k"), F.first("j").cast("string")).alias("name"))
    got = join_unique(rows, groups, ["k", "j"], "n")
    assert got.count() == 3000 and got.columns == ["k", "j", "name"]
    assert got.filter(~F.concat_ws("-", "k", F.col("j").cast("string")).eqNullSafe(F.col("name"))).count() == 0


def test_csv_line_breaks_over_splits(spark, tmp_dir):
    """Quoted fields with line breaks, doubled quotes and the header's own text come back whole, however the files are split."""
    rows = [(f"p{i}", "m", "a\n" * (i % 5) + '"q", \r\n' + "x" * (i * 37 % 400), str(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "player_id string, season string, player string, goals string")
    S.write_partitioned(df, f"{tmp_dir}/c", ["season"])
    want = sorted((p, x, g) for p, _, x, g in rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "4k", "300"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            got = S.read_csv_by_name(spark, f"{tmp_dir}/c", ["player_id", "player", "goals"])
            assert sorted(map(tuple, got.collect())) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_csv_headers_in_one_scan(spark, tmp_dir):
    write(f"{tmp_dir}/h/season_id=s1/a.csv", "player_id,goals\r\np1,1\r\n\r\n\"p2\",\"\"\r\n")
    write(f"{tmp_dir}/h/season_id=s2/b.csv", "goals,tackles_wom,player_id\n5,6,p3\n7\n")
    write(f"{tmp_dir}/h/season_id=s2/c.csv", "")
    df = S.read_csv_by_name(spark, f"{tmp_dir}/h", ["player_id", "goals", "tackles_won", "season_id"])
    assert sorted(map(tuple, df.collect()), key=str) == [("p1", "1", None, "s1"), ("p2", None, None, "s1"), ("p3", "5", "6", "s2"), (None, "7", None, "s2")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("FileScan text") == 1 and "SortMergeJoin" not in plan


def test_unreadable_files_are_reported(spark, tmp_dir):
    import gzip

    write(f"{tmp_dir}/u/good.csv", "season_id,url\ns1,u1\n")
    with gzip.open(f"{tmp_dir}/u/whole.csv.gz", "wb") as f:
        f.write(b"season_id,url\ns2,u2\n")
    data = gzip.compress(b"season_id,url\n" + b"".join(b"x%d,%d\n" % (i, i * i) for i in range(20_000)))
    with open(f"{tmp_dir}/u/cut.csv.gz", "wb") as f:
        f.write(data[: len(data) // 2])
    with open(f"{tmp_dir}/u/latin.csv", "wb") as f:
        f.write(b"season_id,url\ns3,caf\xe9\n")
    assert sorted(r["season_id"] for r in S.load_season_dims(spark, f"{tmp_dir}/u").collect()) == ["s1", "s2"]
    report = {os.path.basename(r["file"]): r["reason"] for r in S.unreadable_files(spark, f"{tmp_dir}/u").collect()}
    assert set(report) == {"cut.csv.gz", "latin.csv"} and report["latin.csv"] == "not UTF-8" and "gzip" in report["cut.csv.gz"]


def test_placeholder_ids_on_load(spark, tmp_dir):
    write(f"{tmp_dir}/p/a.csv", "match_id,season_id,home_team\nnan,s1,nan\n<NA>,None,b\nm1,s1,c\n")
    rows = sorted((r["home_team"], r["match_id"], r["season_id"]) for r in S.load_match_stats(spark, f"{tmp_dir}/p").collect())
    assert rows == [("b", None, None), ("c", "m1", "s1"), ("nan", None, "s1")]


DATE_LAYOUTS = """%Y-%m-%d|%Y/%m/%d|%Y.%m.%d|%Y %m %d|%Y-{m}-{d}|%Y/{m}/{d}|%Y.{m}.{d}|%m/%d/%Y|{m}/{d}/%Y|%m-%d-%Y|{m}-{d}-%Y|%m.%d.%Y|%d/%m/%Y|%d-%m-%Y|%d.%m.%Y|%m/%d/%y|{m}/{d}/%y
%Y%m%d|%y%m%d|%B %d, %Y|%B {d}, %Y|%b %d, %Y|%b {d}, %Y|%b {d} %Y|%B {d} %Y|%d %B %Y|{d} %B %Y|%d %b %Y|{d} %b %Y|{d} %b, %Y|%d-%b-%Y|{d}-%b-%Y|%d-%B-%Y|%d/%b/%Y|%d%b%Y|{d}%b%Y|%b-%d-%Y|%b/%d/%Y
%Y-%b-%d|%Y %b {d}|%Y %B {d}|%Y-%B-%d|%B %Y|%b %Y|%b-%Y|%Y-%m|%m/%Y|%Y/%m|%Y %B|%Y|%A, %B {d}, %Y|%a, %d %b %Y|%a %b {d} %Y|%A {d} %B %Y|%a %d/%m/%Y|%A, {d} %B %Y|{d}th %B %Y|%B {d}th, %Y
{d}th of %B %Y|%d %b %y|%b {d}, '%y|%b {d} %y|%d-%b-%y|%Y-%m-%d %H:%M|%Y-%m-%dT%H:%M:%S|%Y-%m-%dT%H:%M:%SZ|%Y-%m-%d %H:%M:%S.%f|%Y-%m-%d %H:%M:%S+00:00|%Y%m%dT%H%M%S|%m/%d/%Y %H:%M
%m/%d/%Y %I:%M %p|%B {d}, %Y %I:%M %p|%b {d}, %Y at %H:%M|%a, %d %b %Y %H:%M:%S GMT|%H:%M %d %b %Y|%b. {d}, %Y|%d. %B %Y|%d %m %Y|%A|TBD|%b {d}|{d} %b|foo %Y-%m-%d|%Y-%m-%d foo|Postponed|%Y-%d-%m
31/31/%Y|%Y-02-30|%b 32, %Y|%d %b %Y %b|1 2 3 4|""".replace("\n", "|").split("|")


def test_dates_as_pandas_reads_them(spark):
    import datetime as dt
    import warnings

    import pandas as pd

    assert len(DATE_LAYOUTS) > 90
    want = {}
    for layout in DATE_LAYOUTS:
        for y, m, d in ((2021, 3, 7), (2019, 12, 25), (2024, 2, 29), (2020, 10, 11)):
            text = dt.datetime(y, m, d, 19, 30, 5).strftime(layout.replace("{m}", str(m)).replace("{d}", str(d)))
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                value = pd.to_datetime(text, errors="coerce")
            want[text] = None if pd.isna(value) else value.date()
    got = dict(spark.createDataFrame([(t,) for t in want], "t string").select("t", X.try_parse_date("t")).collect())
    assert {t: (got[t], v) for t, v in want.items() if got[t] != v} == {}
    assert spark.createDataFrame([(None,)], "t string").select(X.try_parse_date("t")).first()[0] is None
