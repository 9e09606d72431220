"""The catalogue tables as views of the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reelframe.operators.numbering import number_rows
from reelframe.session import scratch_path

SHELF = 1000  # part keys per shelf: a customer's favourites on one shelf are at most this many


class Views:
    """Lazy DataFrames over one folder of Parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)

    @property
    def content(self) -> DataFrame:
        """Catalogue items; part of them have only an external ID, some lack genre or cast."""
        key = F.col("p_partkey").cast("string")
        return self.table("part").select(
            F.when(F.col("p_type") == "SMALL", F.concat(F.lit("tt"), key)).otherwise(key).alias("ID"),
            F.nullif("p_type", F.lit("PROMO")).alias("Genre"),
            F.col("p_name").alias("CleanTitle"),
            F.concat("p_name", F.lit(" by "), "p_brand", F.lit(" of size "), F.col("p_size").cast("string"))
            .alias("Synopsis"),
            F.col("p_brand").alias("Directors"),
            F.when(F.col("p_size") <= 40, F.concat(F.lit("Cast "), F.col("p_size").cast("string"))).alias("Cast"),
            F.when(F.col("p_size") <= 25, "movie").otherwise("serie").alias("Type"),
            F.col("p_brand").alias("PlatformName"),
        )

    @property
    def offers(self) -> DataFrame:
        """The same items as several platforms deliver them: many rows per ID, with gaps."""
        key, text = F.col("l_partkey").cast("string"), lambda c: F.col(c).cast("string")
        line = F.col("l_linenumber")
        return self.table("lineitem").select(
            F.when(line == 7, F.concat(F.lit("tt"), key)).otherwise(key).alias("ID"),
            F.nullif("l_returnflag", F.lit("R")).alias("Genre"),
            F.when(line == 6, None).when(line == 5, "No Title").otherwise(F.concat(F.lit("Part "), key))
            .alias("CleanTitle"),
            F.when(F.col("l_tax") == 0, "No Synopsis")
            .when(F.col("l_discount") > 0.01, F.concat(F.lit("Order "), text("l_orderkey"))).alias("Synopsis"),
            F.when(F.col("l_suppkey") > 10, F.concat(F.lit("Supplier "), text("l_suppkey"))).alias("Directors"),
            F.when(F.col("l_linestatus") == "O", F.concat(F.lit("Cast "), text("l_suppkey"))).alias("Cast"),
            F.when(F.col("l_quantity") <= 25, "movie").otherwise("serie").alias("Type"),
            F.concat(F.lit("Platform "), text("l_linenumber")).alias("PlatformName"),
        )

    @property
    def id_map(self) -> DataFrame:
        size, key = F.col("p_size"), F.col("p_partkey")
        return self.table("part").select(
            F.concat(F.lit("tt"), key.cast("string")).alias("external_id"),
            F.when(size <= 20, key).alias("movie_id"),
            F.when(size <= 40, key + 1_000_000).alias("tv_id"),
        )

    @property
    def details(self) -> DataFrame:
        size = F.col("p_size").cast("string")
        member = lambda i: F.struct(F.concat(F.lit(f"Actor {i} "), size).alias("name"))
        worker = lambda name, job: F.struct(name.alias("name"), F.lit(job).alias("job"))
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("id"),
            F.when(F.col("p_size") <= 30, F.col("p_name")).alias("title"),
            F.col("p_name").alias("name"),
            F.when(F.col("p_size") > 5, F.concat(F.lit("About "), "p_name")).alias("overview"),
            F.array(F.struct(F.col("p_type").alias("name")), F.struct(F.lit("Any").alias("name"))).alias("genres"),
            F.struct(
                F.array(*[member(i) for i in range(1, 7)]).alias("cast"),
                F.array(worker(F.col("p_brand"), "Director"), worker(F.lit("W"), "Writer"),
                        worker(F.concat(F.lit("D "), size), "Director")).alias("crew"),
            ).alias("credits"),
        )

    @property
    def docs(self) -> DataFrame:
        return self.table("documents").select(
            F.col("doc_id").cast("string").alias("ID"), "doc_id", F.col("text").alias("Synopsis"), "lang",
            F.col("source").alias("PlatformName"), "n_chars")

    @property
    def genres(self) -> DataFrame:
        """Genre dimension: part types numbered in alphabetical order, names with a blank in front."""
        names = self.table("part").select(F.col("p_type").alias("name")).distinct()
        return number_rows(names, "name", name="genero_id").select(
            F.col("genero_id").cast("int").alias("genero_id"),
            F.concat(F.lit(" "), "name").alias("genero_name"))

    @property
    def prefs(self) -> DataFrame:
        """Favourites of a customer on one shelf; the lists are bounded by the shelf.

        Film and series IDs may be unknown to the catalogue, genre IDs 7 and 8 to the
        dimension; every tenth customer has a key of the wrong length.
        """
        bought = (
            self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
            .join(self.table("lineitem").select("l_orderkey", "l_partkey"), "l_orderkey")
            .select("o_custkey", "l_partkey")
        )
        liked = bought.join(
            self.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_size"), "l_partkey")
        ids = lambda c: F.array_join(F.transform(F.array_sort(F.collect_set(c)), lambda x: x.cast("string")), ";")
        movie = F.col("p_size") <= 25
        short = F.concat(F.col("o_custkey").cast("string"), F.lit("-"), F.col("shelf").cast("string"))
        return (
            liked.withColumn("shelf", F.expr(f"l_partkey div {SHELF}"))
            .groupBy("o_custkey", "shelf").agg(
                ids(F.when(movie, F.col("l_partkey"))).alias("favoriteMoviesIds"),
                ids(F.col("p_size") % 8 + 1).alias("favoriteGenresIds"),
                ids(F.when(~movie, F.col("l_partkey"))).alias("favoriteSeriesIds"))
            .select(
                F.when(F.col("o_custkey") % 10 == 9, short).otherwise(F.lpad(short, 36, "0")).alias("userId"),
                "favoriteMoviesIds", "favoriteGenresIds", "favoriteSeriesIds")
        )

    @property
    def stored_prefs(self) -> DataFrame:
        """The preferences as a stored table, for plans that read them more than once."""
        path = self.scratch("prefs")
        self.prefs.write.parquet(path)
        return self.spark.read.parquet(path)

    @property
    def lines(self) -> DataFrame:
        """Feed lines from events: file, line number, text and time."""
        text = lambda c: F.col(c).cast("string")
        kind, value, lit = F.col("event_type"), F.col("value"), F.lit
        user = text("user_id")
        id_part = (
            F.when(kind == "click", F.concat(lit('{"ID":'), user, lit("}")))
            .when(kind == "view", F.concat(lit('{"ID":"'), user, lit('"}')))
            .when(kind == "signup", F.concat(lit('{"ID":"00'), user, lit('"}')))
            .when(kind == "purchase", F.concat(lit('{"ID":true},{"ID":'), user, lit('.5},{"ID":-'),
                                               (F.col("user_id") + 1).cast("string"), lit("}")))
            .otherwise(F.concat(lit('{"ID":"-'), user, lit('"}')))
        )
        links = F.when(value < 50, "{}").when(value < 100, "[1]").otherwise(F.col("props"))
        title = (
            F.when(value < 200, F.concat(lit(',"Title":"E'), text("event_id"), lit('"')))
            .when(value < 300, ',"Title":null').otherwise("")
        )
        whole = F.concat(
            lit('{"ExternalIds":[{"Provider":"x","ID":"tt'), text("event_id"), lit('"},'), id_part,
            lit('],"Deeplinks":'), links, title, lit(',"Type":"'), kind, lit('","Year":'), user,
            lit(',"At":"'), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), lit('"}'))
        return self.table("events").select(
            kind.alias("file_key"), F.col("event_id").alias("line_number"),
            F.when(value > 480, F.substring(whole, 1, 30)).otherwise(whole).alias("line"),
            F.col("ts").alias("processed_at"))

    @property
    def vecs(self) -> DataFrame:
        return self.table("embeddings")


# The same views for the SQL checks.
_SQL = {
    "content": """
        SELECT CASE WHEN p_type = 'SMALL' THEN 'tt' || p_partkey ELSE p_partkey::VARCHAR END AS ID,
               nullif(p_type, 'PROMO') AS Genre, p_name AS CleanTitle,
               p_name || ' by ' || p_brand || ' of size ' || p_size AS Synopsis, p_brand AS Directors,
               CASE WHEN p_size <= 40 THEN 'Cast ' || p_size END AS "Cast",
               CASE WHEN p_size <= 25 THEN 'movie' ELSE 'serie' END AS Type, p_brand AS PlatformName
        FROM part""",
    "offers": """
        SELECT CASE WHEN l_linenumber = 7 THEN 'tt' || l_partkey ELSE l_partkey::VARCHAR END AS ID,
               nullif(l_returnflag, 'R') AS Genre,
               CASE WHEN l_linenumber = 6 THEN NULL WHEN l_linenumber = 5 THEN 'No Title'
                    ELSE 'Part ' || l_partkey END AS CleanTitle,
               CASE WHEN l_tax = 0 THEN 'No Synopsis'
                    WHEN l_discount > 0.01::DOUBLE THEN 'Order ' || l_orderkey END AS Synopsis,
               CASE WHEN l_suppkey > 10 THEN 'Supplier ' || l_suppkey END AS Directors,
               CASE WHEN l_linestatus = 'O' THEN 'Cast ' || l_suppkey END AS "Cast",
               CASE WHEN l_quantity <= 25 THEN 'movie' ELSE 'serie' END AS Type,
               'Platform ' || l_linenumber AS PlatformName
        FROM lineitem""",
    "filled": """
        SELECT ID, coalesce(Genre, 'No Genre') AS Genre, coalesce(CleanTitle, 'No CleanTitle') AS CleanTitle,
               coalesce(Synopsis, 'No Synopsis') AS Synopsis, coalesce(Directors, 'No Directors') AS Directors,
               coalesce("Cast", 'No Cast') AS "Cast", Type, PlatformName
        FROM offers""",
    "scored": """
        SELECT *, CASE WHEN CleanTitle <> 'No Title' THEN 2.0::DOUBLE ELSE 0 END
                + CASE WHEN Genre <> 'No Genre' THEN 2.0::DOUBLE ELSE 0 END
                + CASE WHEN Synopsis <> 'No Synopsis' THEN 2.0::DOUBLE ELSE 0 END
                + CASE WHEN Directors <> 'No Directors' THEN 0.5::DOUBLE ELSE 0 END
                + CASE WHEN "Cast" <> 'No Cast' THEN 0.5::DOUBLE ELSE 0 END AS Score
        FROM filled""",
    "best": """
        SELECT * FROM scored QUALIFY row_number() OVER (
            PARTITION BY ID ORDER BY Score DESC, PlatformName, CleanTitle, Synopsis, Directors, "Cast", Genre, Type
        ) = 1""",
    "id_map": """
        SELECT 'tt' || p_partkey AS external_id, CASE WHEN p_size <= 20 THEN p_partkey END AS movie_id,
               CASE WHEN p_size <= 40 THEN p_partkey + 1000000 END AS tv_id
        FROM part""",
    "details": """
        SELECT p_partkey::VARCHAR AS id, p_name AS title, coalesce(CASE WHEN p_size > 5 THEN 'About ' || p_name END, '')
               AS overview, p_type || ', Any' AS genres,
               'Actor 1 ' || p_size || ', Actor 2 ' || p_size || ', Actor 3 ' || p_size || ', Actor 4 ' || p_size
               || ', Actor 5 ' || p_size AS cast_names, p_brand || ', D ' || p_size AS director_names
        FROM part""",
    "docs": """
        SELECT doc_id::VARCHAR AS ID, doc_id, text AS Synopsis, lang, source AS PlatformName, n_chars
        FROM documents""",
    "genres": """
        SELECT dense_rank() OVER (ORDER BY p_type)::INT AS genero_id, ' ' || p_type AS genero_name
        FROM (SELECT DISTINCT p_type FROM part)""",
    "prefs": """
        SELECT CASE WHEN o_custkey % 10 = 9 THEN o_custkey || '-' || (l_partkey // 1000)
                    ELSE lpad(o_custkey || '-' || (l_partkey // 1000), 36, '0') END AS userId,
               coalesce(string_agg(CASE WHEN p_size <= 25 THEN l_partkey::VARCHAR END, ';' ORDER BY l_partkey), '')
                   AS favoriteMoviesIds,
               array_to_string(list_sort(list(DISTINCT p_size % 8 + 1)), ';') AS favoriteGenresIds,
               coalesce(string_agg(CASE WHEN p_size > 25 THEN l_partkey::VARCHAR END, ';' ORDER BY l_partkey), '')
                   AS favoriteSeriesIds
        FROM (SELECT DISTINCT o_custkey, l_partkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
        JOIN part ON p_partkey = l_partkey
        GROUP BY o_custkey, l_partkey // 1000""",
    "users": """
        SELECT * FROM prefs WHERE length(userId) = 36 AND favoriteMoviesIds <> '' AND favoriteSeriesIds <> ''
          AND favoriteGenresIds <> ''""",
    "records": """
        SELECT event_type AS file_key, event_id AS line_number, ts AS processed_at, value > 480 AS malformed,
               CASE WHEN value > 480 THEN NULL
                    WHEN event_type IN ('click', 'view') THEN user_id::VARCHAR
                    WHEN event_type = 'signup' THEN '00' || user_id
                    WHEN event_type = 'purchase' THEN '-' || (user_id + 1) END AS extracted_id,
               CASE WHEN value < 100 OR value > 480 THEN '{}' ELSE replace(props, ' ', '') END AS deeplinks,
               CASE WHEN value > 480 OR value >= 300 THEN '' WHEN value < 200 THEN 'E' || event_id END AS title,
               CASE WHEN value > 480 THEN '' ELSE event_type END AS kind,
               CASE WHEN value <= 480 THEN user_id::VARCHAR END AS year
        FROM events""",
    "movie_rows": """
        SELECT userId, unnest(string_split(favoriteMoviesIds, ';')) AS item,
               generate_subscripts(string_split(favoriteMoviesIds, ';'), 1) - 1 AS pos
        FROM users""",
    "serie_rows": """
        SELECT userId, unnest(string_split(favoriteSeriesIds, ';')) AS item,
               generate_subscripts(string_split(favoriteSeriesIds, ';'), 1) - 1 AS pos
        FROM users""",
    "genre_rows": """
        SELECT userId, unnest(string_split(favoriteGenresIds, ';')) AS item,
               generate_subscripts(string_split(favoriteGenresIds, ';'), 1) - 1 AS pos
        FROM users""",
    "pairs": """
        SELECT u.vec_id AS user_id, v.vec_id AS item_id,
               list_cosine_similarity(u.embedding::DOUBLE[], v.embedding::DOUBLE[]) AS exact, round(exact, 9) AS score
        FROM embeddings u CROSS JOIN embeddings v""",
    "centroids": """
        SELECT label, list(m ORDER BY pos) AS centroid FROM (
            SELECT label, pos, avg(x) AS m FROM (
                SELECT label, unnest(embedding::DOUBLE[]) AS x,
                       generate_subscripts(embedding, 1) AS pos FROM embeddings)
            GROUP BY label, pos)
        GROUP BY label""",
}
_NEEDS = {"filled": ["offers"], "scored": ["filled"], "best": ["scored"], "users": ["prefs"],
          "movie_rows": ["users"], "serie_rows": ["users"], "genre_rows": ["users"]}


def sql(body: str, *views: str, recursive: bool = False) -> str:
    """``body`` preceded by the named views and those they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        add(view)
    clauses = ",\n".join(f"{name} AS ({_SQL[name]}\n)" for name in ordered)
    word = "WITH RECURSIVE" if recursive else "WITH"
    return f"{word} {clauses}{',' if recursive else ''}\n{body}" if clauses else body
