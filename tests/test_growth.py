"""What queries do must be dealt over tasks however the rows fall."""

from pyspark.sql import functions as F

from fitloom.plans import q_generate as G

SF = "/root/testdata/sf0.001"


def test_rows_of_a_role_and_of_a_tier_are_in_many_tasks(spark):
    made = G.made(spark, SF, "school").where("preset = 'balanced'").select("role", "tier", F.spark_partition_id().alias("task"))
    for by in ("role", "tier"):
        most = made.groupBy(by).agg(F.count_distinct("task").alias("tasks"), F.count("*").alias("n")).where("n >= 20").collect()
        assert most and all(r.tasks > 1 for r in most), most


def test_figures_alone_are_those_of_projects(spark):
    figures = lambda part, c: {(r.jd_id, r.preset, tuple(map(lambda m: tuple(sorted(m.items())), r.m))) for r in G.made(spark, SF, part).select("jd_id", "preset", F.expr(c).alias("m")).collect()}
    assert figures("metrics", "metrics") == figures("projects", "transform(projects, p -> p.quantitative_metrics)")
    assert "project_name" not in G.Q["SMP17"][0](spark, SF)._jdf.queryExecution().optimizedPlan().toString()


def test_calls_are_dealt_over_more_tasks_as_rows_grow(spark, tmp_path, monkeypatch):
    """A task has few rows however many there are, a log serves a table that grew, and the rate is shared by all."""
    from fitloom.operators import external as X

    class Named:
        def complete(self, prompt, settings):
            return prompt.upper()

    class New:
        """A client that answers rows from 60 on only."""

        def complete(self, prompt, settings):
            if int(prompt[1:]) < 60:
                raise RuntimeError("paid twice")
            return prompt.upper()

    def shares(rpm, tasks):
        (tmp_path / f"shares-{tasks}").touch()
        return X.Limiter(rpm, tasks)

    monkeypatch.setattr(X, "ROWS", 10)
    table = lambda n: spark.range(n).select("id", F.array(F.concat(F.lit("p"), "id")).alias("prompts"))
    for log in (None, f"file://{tmp_path}/log"):
        done = X.complete(table(60), "prompts", Named, rpm=1e9, tasks=1, log=log, key="id", limiter=shares).withColumn("task", F.spark_partition_id()).collect()
        assert {(r.id, r.answer) for r in done} == {(i, f"P{i}") for i in range(60)} and len({r.task for r in done}) > 3
    grown = X.complete(table(200), "prompts", New, rpm=1e9, tasks=1, log=f"file://{tmp_path}/log", key="id").collect()
    assert {(r.id, r.answer) for r in grown} == {(i, f"P{i}") for i in range(200)}
    assert (tmp_path / f"shares-{min(6, spark.sparkContext.defaultParallelism)}").exists() and not (tmp_path / "shares-1").exists()


def test_rows_with_an_inventory_are_not_dealt_again_for_resumes(spark):
    """Resumes meet the orders: of a candidate's row nothing but ranks is dealt by order, and nothing by resume."""
    from fitloom.plans import q_data

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("PRJ5", "EXT10", "JOI2", "JOI3", "JOI4"):
            plan = q_data.Q[name][0](spark, SF)._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning(custkey" in plan and "hashpartitioning(resume_id" not in plan and "_resume#" not in plan, name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_forms_are_made_once_and_dealt_by_their_number(spark, monkeypatch):
    from fitloom.operators import fuzzy
    from fitloom.plans import q_score

    monkeypatch.setattr(fuzzy, "FORMS", 50)
    found = q_score.Q["JOI6_tables"][0](spark, SF)
    assert not any("documents" in f for f in found.inputFiles())
    words = [spark.createDataFrame(q_score._words(spark, SF, t).orderBy("word").limit(300).collect(), "word string") for t in ("benchmark", "documents")]
    pairs = lambda **more: sorted(map(tuple, fuzzy.matching_forms(*words, **more).collect()))
    assert pairs() and pairs(store=q_score._forms) == pairs()


def test_packing_costs_little_more_than_passing_the_tokens(spark):
    """Tokens go through Python as whole arrays: lists of Python numbers took some 2 microseconds a token."""
    import time

    from fitloom.operators import packing

    ids = F.sequence(F.lit(1), F.lit(1000))
    rows = spark.range(0, 8000, 1, 1).select("id", F.lit(0).alias("copy"), ids.alias("ids"), ids.alias("labels")).cache()

    def seconds(df):
        began = time.time()
        df.write.format("noop").mode("overwrite").save()
        return time.time() - began

    assert rows.count() == 8000
    passed = rows.drop("copy").repartition(1).mapInArrow(lambda batches: batches, "id long, ids array<int>, labels array<int>")
    packs = packing.packed(rows, "id", tasks=1)
    seconds(passed), seconds(packs)
    assert seconds(packs) < 2 * seconds(passed) + 3
    assert packs.count() == 8000
    rows.unpersist()


def test_rows_that_pass_early_are_not_made_again(spark):
    """Attempts 4 to 6 are made for those rows only that attempts 1 to 3 left open."""
    from fitloom.operators import generate

    sizes = []

    def make(rows):
        good = F.col("attempt") == F.col("id") + 1
        return rows.select("id", "attempt", F.lit("full_match").alias("preset"), F.when(good, 0.9).otherwise(0.1).alias("overall"), F.lit(1.0).alias("experience_fit"), F.lit("r").alias("jd_role"), F.lit("r").alias("role"))

    def store(df):
        kept = spark.createDataFrame(df.collect(), df.schema)
        sizes.append(kept.count())
        return kept

    got = generate.accepted(spark.range(8), ["id"], make, store, 6, ends=(1, 3, 6)).collect()
    assert sorted((r.id, r.attempt, r.accepted) for r in got) == [(i, min(i + 1, 6), i < 6) for i in range(8)]
    assert sizes == [8, 7 * 2, 5 * 3]
