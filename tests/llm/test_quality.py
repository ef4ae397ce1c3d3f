from varloom.llm.quality import quality_rules


def words(tag, n):
    return " ".join(f"{tag}{i}" for i in range(n))


def test_frequent_lines_deplete_documents(spark):
    common = words("c", 60)
    docs = [(i, f"{common.upper() if i % 2 else common}\n{words(f'own{i}x', 20 if i < 5 else 80)}", "a") for i in range(20)]
    docs += [(100 + i, f"{common}\n{words(f'b{i}x', 20)}", "b") for i in range(5)]
    docs += [(200 + i, words("copy", 90), "a") for i in range(40)]
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()}
    assert [got[i].kept for i in range(20)] == [i >= 5 for i in range(20)]
    assert all(got[i].n_removed_words == 60 and not got[i].base_failed for i in range(20))
    assert all(got[100 + i].kept and got[100 + i].n_removed_words == 0 for i in range(5))
    assert all(got[200 + i].kept for i in range(40))


def test_odd_rows_have_defined_results(spark):
    long = words("w", 30_000)
    docs = [(1, None, None), (2, "", "a"), (3, " \n\t\n", "a"), (4, "x x\nx x\n\nx x", "a"), (5, long, None), (5, long, None), (None, long, "a")]
    df = spark.createDataFrame([(*d, 1, 2, 3) for d in docs], "doc_id long, text string, source string, host int, row int, lines int")
    got = sorted(((r.doc_id, r.n_words, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in quality_rules(df).collect()), key=repr)
    want = [(1, 0, 0, 0, True, False), (2, 0, 0, 0, True, False), (3, 0, 0, 0, True, False), (4, 6, 2, 6, True, False)]
    want += [(5, 30_000, 0, 0, False, True)] * 2 + [(None, 30_000, 0, 0, False, True)]
    assert got == sorted(want, key=repr)
    assert not quality_rules(df.limit(0)).count()


def test_repeated_rows_count_once_as_in_the_sql(spark):
    import duckdb

    from varloom.llm.queries import LINES_SQL

    common = words("c", 60)
    docs = [(i, f"{words(f'own{i}x', 70)}\n{common if i < 11 else ''}", "a") for i in range(30)]
    docs += [(100, f"{words('rep', 60)}\n{words('eat', 40)}", "a")] * 12
    docs += [(200, f"{words('first', 60)}\n{words('both', 50)}", "a"), (200, f"{words('second', 60)}\n{words('both', 50)}", "a")]
    # Lines that stand exactly on the limit of ten documents, and in one more.
    docs += [(300 + i, f"{words(f'l{i}x', 70)}\n{words('ten', 55)}\n{words('more', 55) if i else ''}", "b") for i in range(10)]
    docs += [(400 + i, f"{words(f'm{i}x', 70)}\n{words('more', 55)}", "b") for i in range(2)]
    # Exactly two percent of 600 documents, and one document more.
    docs += [(1000 + i, f"{words(f'n{i}x', 60)}\n{words('even', 55) if i < 12 else ''}\n{words('over', 55) if i < 13 else ''}", "c") for i in range(600)]
    documents = spark.createDataFrame(docs, "doc_id long, text string, source string")
    columns = ["doc_id", "n_words", "base_failed", "kept", "n_removed_words", "n_frequent_lines"]
    got = sorted(map(tuple, quality_rules(documents).select(columns).collect()))
    pandas = documents.toPandas()
    expected = duckdb.connect().register("documents", pandas).sql(f"SELECT DISTINCT {', '.join(columns)} FROM ({LINES_SQL})").fetchall()
    # The SQL sums the rows of an id, so the two ids with several rows are judged below.
    once = [r for r in got if r[0] not in (100, 200)]
    assert once == sorted(r for r in expected if r[0] not in (100, 200))
    kept, gone = ({g[0]: g[i] for g in got} for i in (3, 4))
    assert len(got) == len(docs) and kept[100] and kept[200]
    assert (gone[300], gone[301], gone[400], gone[1000], gone[1012], gone[1013]) == (0, 55, 55, 55, 55, 0)
