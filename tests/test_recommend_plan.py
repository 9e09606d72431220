"""The whole way from favourites to lists, against brute force."""

import numpy as np
import pytest

from reelframe.plans.embed import embed_items
from reelframe.plans.recommend import recommend_for_all, user_profiles, with_sentences


def vector(text):
    return [text.count(c) / len(text) for c in "aeiou"]


@pytest.mark.parametrize("exclude_seen", [False, True])
def test_recommendations_for_all(spark, exclude_seen):
    load = lambda: (lambda texts: [[t.count(c) / len(t) for c in "aeiou"] for t in texts])
    rng = np.random.default_rng(1)
    word = lambda: "".join(rng.choice(list("aeioubc"), 6))
    content = spark.createDataFrame(
        [(str(i), word(), word(), word(), word(), word()) for i in range(40)],
        "ID string, Genre string, CleanTitle string, Synopsis string, Cast string, Directors string")
    genres = spark.createDataFrame([(1, " Adventure"), (2, " Comedy")], "genero_id int, genero_name string")
    pick = lambda n: ";".join(str(i) for i in rng.choice(50, n, replace=False))  # some are not in the catalogue
    prefs = spark.createDataFrame(
        [(f"{u:036d}", pick(4), "1;2" if u % 2 else "2;9", pick(3)) for u in range(9)],
        "userId string, favoriteMoviesIds string, favoriteGenresIds string, favoriteSeriesIds string")
    embedded = embed_items(content, load, "full").select("ID", "embedding").collect()
    items = spark.createDataFrame([(r["ID"], r["embedding"]) for r in embedded], "ID string, embedding array<float>")
    found = recommend_for_all(prefs, content, genres, items, load, 3, 5, exclude_seen).collect()

    single = lambda v: np.asarray(v, dtype=np.float32).astype(float)
    unit = lambda v: single(v) / np.linalg.norm(single(v))
    want = []
    for row in with_sentences(user_profiles(prefs, content, genres)).collect():
        for kind, liked, k in (("movies", "favoriteMoviesIds", 3), ("series", "favoriteSeriesIds", 5)):
            user = unit(vector(row[f"{kind}_sentences_to_embed"]))
            seen = set(row[liked].split(";")) if exclude_seen else set()
            scores = sorted((-round(float(unit(r["embedding"]) @ user), 9), r["ID"])
                            for r in embedded if r["ID"] not in seen)
            want += [(row["userId"], kind, rank, i) for rank, (_, i) in enumerate(scores[:k], 1)]
    assert sorted((r["userId"], r["kind"], r["rank"], r["ID"]) for r in found) == sorted(want)
    assert len(want) == 9 * 8
