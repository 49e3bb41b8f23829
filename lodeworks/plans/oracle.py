"""The registered queries in plain SQL, for a single-node engine to check against."""

from __future__ import annotations

# Derived inputs as common table expressions over the base tables.
VIEWS = {
    "v_movies": """
        select p_partkey as MovieID, p_name as MovieTitle, replace(p_name, ' ', '|') as Genres from part""",
    "v_genres": "select MovieID, unnest(string_split(Genres, '|')) as genre from v_movies",
    "v_ratings": """
        select o_custkey as UserID, l_partkey as MovieID, l_quantity as Rating
        from lineitem join orders on l_orderkey = o_orderkey""",
    "v_stats": """
        select MovieID, sum(Rating) / count(*) as AvgRating, count(*) as TotalReviews
        from v_ratings group by MovieID""",
    "v_interactions": """
        select o_custkey as UserID, l_suppkey as ItemID, sum(l_quantity) / count(*) as Rating
        from lineitem join orders on l_orderkey = o_orderkey group by o_custkey, l_suppkey""",
    "v_tweets": """
        select event_id, ts, concat(event_type, ',#', event_type, cast(user_id % 40 as varchar), ' from u',
            cast(user_id as varchar), ' #u', cast(user_id as varchar)) as text from events""",
    "v_fields": "select event_id, ts, unnest(string_split(trim(text), ',')) as field from v_tweets",
    "v_tokens": "select event_id, ts, unnest(string_split(field, ' ')) as token from v_fields",
    "v_tags": "select event_id, ts, token from v_tokens where starts_with(token, '#')",
    "v_first": """
        select token, count(*) as n_first from v_tags
        where ts < timestamp '2024-01-16 00:00:00' group by token""",
    "v_second": """
        select token, count(*) as n_second from v_tags
        where ts >= timestamp '2024-01-16 00:00:00' group by token""",
    "v_words": """
        select unnest(string_split(trim(line, ' ' || chr(9) || chr(13)), ' ')) as word
        from (select unnest(string_split(text, chr(10))) as line from documents)""",
    "v_scanners": """
        select o_orderkey as scanner, string_agg(distinct p_brand, '-' order by p_brand) as ports_scanned_str,
            cast(count(distinct p_brand) as bigint) as numports, max(o_totalprice) as lifetime,
            sum(l_quantity) as Packets, max(o_orderstatus) = 'P' as mirai,
            max(o_orderpriority) = '1-URGENT' as zmap, max(o_orderpriority) = '5-LOW' as masscan
        from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
        group by o_orderkey""",
    "v_ports": "select scanner, numports, unnest(string_split(ports_scanned_str, '-')) as item from v_scanners",
    "v_ranked": """
        select item, n, row_number() over (order by n desc, item) as place
        from (select item, count(*) as n from v_ports group by item)""",
    "v_hot": """
        select scanner, numports as cluster, 'Port' || cast(place as varchar) as feature
        from v_ports join v_ranked using (item) where place <= 10""",
    "v_hot_counts": "select cluster, feature, count(*) as n from v_hot group by cluster, feature",
    "v_size": "select count(*) as baskets from v_scanners",
    "v_pairs": """
        select a.item as item_1, b.item as item_2, count(*) as n
        from v_ports a join v_ports b on a.scanner = b.scanner and a.item < b.item group by 1, 2""",
    "v_triples": """
        select a.item as item_1, b.item as item_2, c.item as item_3, count(*) as n
        from v_ports a join v_ports b on a.scanner = b.scanner and a.item < b.item
        join v_ports c on a.scanner = c.scanner and b.item < c.item group by 1, 2, 3""",
    "v_fours": """
        select a.item as item_1, b.item as item_2, c.item as item_3, d.item as item_4, count(*) as n
        from v_ports a join v_ports b on a.scanner = b.scanner and a.item < b.item
        join v_ports c on a.scanner = c.scanner and b.item < c.item
        join v_ports d on a.scanner = d.scanner and c.item < d.item group by 1, 2, 3, 4""",
    "v_biopsies": """
        select l_orderkey as id, l_linenumber as line, l_quantity as clump, l_discount as cell_size,
            l_tax as mitoses,
            case when l_linenumber = 7 then '?' else cast(l_linenumber as varchar) end as bare_nuclei,
            case when l_quantity + 200 * l_discount > 40 then 4 else 2 end as class
        from lineitem""",
    "v_split": """
        select l_orderkey, l_linenumber, l_partkey as MovieID, l_quantity as Rating,
            cast('0x' || substr(md5(concat(l_orderkey, ':', l_linenumber, ':137')), 1, 8) as bigint) % 5 as bucket
        from lineitem""",
    "v_dims": """
        select vec_id, label, generate_subscripts(embedding, 1) - 1 as dim,
            cast(unnest(embedding) as double) as x from embeddings""",
    "v_means": "select label, dim, avg(x) as value from v_dims group by label, dim",
}

# What each view reads from the others.
USES = {
    "v_genres": ["v_movies"], "v_stats": ["v_ratings"], "v_fields": ["v_tweets"],
    "v_tokens": ["v_fields"], "v_tags": ["v_tokens"], "v_first": ["v_tags"], "v_second": ["v_tags"],
    "v_ports": ["v_scanners"], "v_ranked": ["v_ports"], "v_hot": ["v_ports", "v_ranked"],
    "v_hot_counts": ["v_hot"], "v_size": ["v_scanners"], "v_pairs": ["v_ports"],
    "v_triples": ["v_ports"], "v_fours": ["v_ports"], "v_means": ["v_dims"],
}


def _with(views: list[str], select: str) -> str:
    ordered: list[str] = []

    def add(view: str) -> None:
        for used in USES.get(view, []):
            add(used)
        if view not in ordered:
            ordered.append(view)

    for view in views:
        add(view)
    ctes = ",\n".join(f"{v} as ({VIEWS[v].strip()})" for v in ordered)
    return f"with {ctes}\n{select.strip()}" if ordered else select.strip()


_HOT_COLUMNS = ",\n".join(
    f"coalesce(bool_or(place = {i}), false) as Port{i}" for i in range(1, 11)
)
_THERMO_COLUMNS = ",\n".join(
    [f"Packets > {bound} as TE_{i}" for i, bound in enumerate([0] + [2**j for j in range(16)])]
)

def _als_sql(seed: int, reg: float, iters: int) -> str:
    """Alternating least squares of rank two: each half-step sums the equations and solves them by Cramer's rule."""
    def start(place: int) -> str:
        return f"('0x' || substr(md5(concat_ws(':', u, '{place}', '{seed}')), 1, 8))::bigint / 4294967296.0 / sqrt(2.0)"

    steps, users = [], "u0"
    for n in range(1, iters + 1):
        for side, known, other, name in (("i", users, "u", f"i{n}"), ("u", f"i{n}", "i", f"u{n}")):
            steps.append(f"""
        , {name}_sums as (select {side}, sum(f1 * f1) + {reg} * count(*) as a, sum(f1 * f2) as b,
            sum(f2 * f2) + {reg} * count(*) as c, sum(f1 * x) as p, sum(f2 * x) as q from r join {known} using ({other}) group by {side})
        , {name} as (select {side}, (c * p - b * q) / (a * c - b * b) as f1, (a * q - b * p) / (a * c - b * b) as f2 from {name}_sums)""")
        users = f"u{n}"
    return f"""
        with m as (select o_custkey as u, l_suppkey as i, sum(l_quantity) / count(*) as x
            from lineitem join orders on l_orderkey = o_orderkey group by all)
        , s as (select *, ('0x' || substr(md5(concat_ws(':', u, i, '137')), 1, 8))::bigint % 5 < 4 as train from m)
        , r as (select u, i, x from s where train)
        , u0 as (select u, {start(0)} as f1, {start(1)} as f2 from (select distinct u from r)){"".join(steps)}
        select s.u as UserID, s.i as ItemID, round(a.f1 * b.f1 + a.f2 * b.f2, 3) as prediction
        from s join {users} a on a.u = s.u join i{iters} b on b.i = s.i where not train"""


def _lloyd_sql(k: int, rounds: int) -> str:
    """Plain rounds of k-means: nearest centre by row, mean by centre and dimension."""
    steps = []
    for n in range(1, rounds + 1):
        steps.append(f"""
        , a{n} as (select vec_id, any_value(v) as v, arg_min(cluster, list_distance(v, c)) as cluster, min(list_distance(v, c)) as distance
            from p, c{n - 1} group by vec_id)
        , m{n} as (select cluster, dim, avg(x) as x from (
            select cluster, unnest(v) as x, unnest(range(len(v))) as dim from a{n}) group by cluster, dim)
        , c{n} as (select o.cluster, coalesce(any_value(l.c), any_value(o.c)) as c from c{n - 1} o left join (
            select cluster, list(x order by dim) as c from m{n} group by cluster) l on l.cluster = o.cluster group by o.cluster)""")
    return f"""
        with p as (select vec_id, embedding::double[] as v from embeddings)
        , c0 as (select row_number() over (order by vec_id) - 1 as cluster, v as c from p qualify cluster < {k}){"".join(steps)}
        select vec_id, cluster, round(distance, 5) as distance from a{rounds}"""


ORACLE: dict[str, str] = {
    # sources and sinks
    "csv_roundtrip": "select * from part",
    "csv_inferred": """
        select p_partkey, p_name, p_retailprice, 'int' as p_partkey_type, 'string' as p_name_type,
            'double' as p_retailprice_type from part""",
    "text_lines": "select unnest(string_split(text, chr(10))) as value from documents",
    "sink_roundtrip": _with(["v_genres"], "select genre, count(*) as n from v_genres group by genre"),
    "typed_projection": """
        select cast(p_partkey as integer) as p_partkey, p_name, cast(p_size as bigint) as p_size,
            cast(p_retailprice as double) as p_retailprice from part""",
    # projections
    "select_columns": _with(["v_ratings"], "select UserID, MovieID, Rating from v_ratings"),
    "derive_columns": """
        select l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_quantity > 25 as is_bulk,
            l_extendedprice / 2 as half_price from lineitem""",
    "split_array": _with(["v_movies"], """
        select MovieID, cast(len(string_split(Genres, '|')) as bigint) as n_genres,
            string_split(Genres, '|')[1] as first_genre, string_split(Genres, '|')[-1] as last_genre
        from v_movies"""),
    "genre_explode": _with(["v_genres"], "select MovieID, genre from v_genres"),
    "tokenize_fields": _with(["v_tokens"], "select event_id, token from v_tokens"),
    "collapse_ws_counts": r"""
        select word, count(*) as n
        from (select unnest(string_split(regexp_replace(text, '\s+', ' ', 'g'), ' ')) as word from documents)
        group by word""",
    # filters
    "prefix_filter": _with(["v_tags"], "select event_id, token from v_tags"),
    "hashtag_min_count": _with(["v_tweets"], """
        , c as (select token, count(*) as n
            from (select unnest(string_split(trim(text), ' ')) as token from v_tweets)
            where starts_with(token, '#') group by token)
        select token, n from c where n > 66 order by n desc, token"""),
    "top_rated_filter": _with(["v_stats"], """
        select MovieID, AvgRating, TotalReviews from v_stats where AvgRating > 26 and TotalReviews > 20"""),
    "genre_filter": _with(["v_movies"], """
        select MovieID, MovieTitle from v_movies where list_contains(string_split(Genres, '|'), 'blue')"""),
    "min_items_filter": _with(["v_scanners"], """
        select scanner, cast(len(string_split(ports_scanned_str, '-')) as bigint) as numports
        from v_scanners where len(string_split(ports_scanned_str, '-')) > 2"""),
    "flag_filter": _with(["v_scanners"], "select scanner, Packets from v_scanners where mirai"),
    "select_clusters": _with(["v_scanners"], """
        select scanner, numports as cluster from v_scanners where numports = 2 or numports = 5"""),
    "clusters_above_ratio": _with(["v_scanners"], """
        select numports as cluster, count(*) as size, sum(cast(zmap as integer)) / count(*) as zmap_ratio
        from v_scanners group by numports having sum(cast(zmap as integer)) / count(*) >= 0.2"""),
    "rows_of_clusters_above": _with(["v_scanners"], """
        select scanner, numports as cluster from v_scanners where numports in (
            select numports from v_scanners group by numports
            having sum(cast(zmap as integer)) / count(*) >= 0.2)"""),
    "filter_impact": _with(["v_scanners"], """
        select count(*) as n_before, count(*) filter (numports > 2) as n_after,
            count(*) filter (numports > 2) / count(*) as kept_ratio from v_scanners"""),
    # joins
    "ratings_join_movies": _with(["v_ratings", "v_movies"], """
        select UserID, MovieID, Rating, MovieTitle from v_ratings join v_movies using (MovieID)"""),
    "two_period_join": _with(["v_first", "v_second"], """
        select token, n_first, coalesce(n_second, 0) as n_second
        from v_first left join v_second using (token)"""),
    "two_period_trend": _with(["v_first", "v_second"], """
        select token, n_first, coalesce(n_second, 0) as n_second, n_first + coalesce(n_second, 0) as n_total
        from v_first left join v_second using (token)
        where n_first > 33
        order by n_total desc, token"""),
    "rating_error_join": _with(["v_interactions"], """
        , p as (select ItemID, avg(Rating) as prediction from v_interactions group by ItemID)
        select UserID, ItemID, round(Rating, 6) as Rating, round(prediction, 6) as prediction,
            round((Rating - prediction) * (Rating - prediction), 6) as sq_error
        from v_interactions join p using (ItemID)"""),
    # aggregates and ranking
    "word_count": _with(["v_words"], "select word, count(*) as n from v_words group by word"),
    "word_count_sorted": _with(["v_words"], """
        select word, count(*) as n from v_words group by word order by n desc, word"""),
    "hashtag_count": _with(["v_tweets"], """
        select token, count(*) as n
        from (select unnest(string_split(trim(text), ' ')) as token from v_tweets)
        where starts_with(token, '#') group by token"""),
    "hashtag_total": _with(["v_tags"], "select count(*) as n from v_tags"),
    "top_k_hashtags": _with(["v_tags"], """
        select token, count(*) as n from v_tags group by token order by n desc, token limit 100"""),
    "genre_count": _with(["v_genres"], "select genre, count(*) as n from v_genres group by genre"),
    "genre_ranked": _with(["v_stats", "v_movies"], """
        select MovieID, AvgRating, TotalReviews, MovieTitle from v_stats join v_movies using (MovieID)
        where list_contains(string_split(Genres, '|'), 'blue') order by TotalReviews desc, MovieID"""),
    "item_count": _with(["v_ports"], "select item, count(*) as n from v_ports group by item"),
    "distinct_items": _with(["v_ports"], "select count(distinct item) as n from v_ports"),
    "top_n_items": _with(["v_ranked"], "select item, n from v_ranked where place <= 10"),
    "rating_sum": _with(["v_ratings"], """
        select MovieID, sum(Rating) as total_rating from v_ratings group by MovieID"""),
    "rating_stats": _with(["v_stats"], "select MovieID, AvgRating, TotalReviews from v_stats"),
    "top_rated_in_genre": _with(["v_stats", "v_movies"], """
        select MovieID, AvgRating, TotalReviews, MovieTitle from v_stats join v_movies using (MovieID)
        where list_contains(string_split(Genres, '|'), 'blue') and AvgRating > 26 and TotalReviews > 20
        order by AvgRating desc, MovieID limit 10"""),
    "top_rated_fast": _with(["v_stats", "v_movies"], """
        select MovieID, AvgRating, TotalReviews, MovieTitle from v_stats join v_movies using (MovieID)
        where list_contains(string_split(Genres, '|'), 'red') and AvgRating > 25 and TotalReviews > 25
        order by TotalReviews desc, MovieID"""),
    # splits
    "hash_split_3way": _with(["v_split"], """
        select l_orderkey, l_linenumber,
            cast(case when bucket < 3 then 0 when bucket < 4 then 1 else 2 end as integer) as split from v_split"""),
    "hash_split_2way": """
        select l_orderkey, l_linenumber, cast(case when
            cast('0x' || substr(md5(concat(l_orderkey, ':', l_linenumber, ':1234')), 1, 8) as bigint) % 10 < 7
            then 0 else 1 end as integer) as split from lineitem""",
    # features
    "multi_hot_topn": _with(["v_ports", "v_ranked"], f"""
        select scanner, {_HOT_COLUMNS}
        from v_ports join v_ranked using (item) group by scanner"""),
    "multi_hot_vector": _with(["v_ports", "v_ranked"], f"""
        select scanner, {_HOT_COLUMNS}
        from v_ports join v_ranked using (item) group by scanner"""),
    "thermometer_encode": _with(["v_scanners"], f"select scanner, {_THERMO_COLUMNS} from v_scanners"),
    "string_index": _with(["v_biopsies"], """
        , r as (select bare_nuclei, row_number() over (order by count(*) desc, bare_nuclei) - 1 as place
            from v_biopsies group by bare_nuclei)
        select id, line, bare_nuclei, cast(place as double) as bare_index
        from v_biopsies join r using (bare_nuclei)"""),
    "index_roundtrip": """
        with r as (select event_type, row_number() over (order by count(*) desc, event_type) - 1 as place
            from events group by event_type)
        select event_id, event_type, cast(place as double) as type_index, event_type as type_again
        from events join r using (event_type)""",
    "assemble_features": _with(["v_biopsies"], """
        select id, line, clump as f_0, cell_size as f_1, mitoses as f_2,
            case when clump > 25 then 1.0::double else 0.0::double end as f_3 from v_biopsies"""),
    "scale_features": """
        select l_orderkey, l_linenumber, l_quantity / 255.0::double as l_quantity,
            l_extendedprice / 255.0::double as l_extendedprice from lineitem""",
    "clean_missing": _with(["v_biopsies"], """
        select id, line, try_cast(bare_nuclei as double) as bare_nuclei from v_biopsies"""),
    "impute_missing": _with(["v_biopsies"], """
        , c as (select id, line, try_cast(bare_nuclei as double) as x from v_biopsies)
        select id, line, round(coalesce(x, (select avg(x) from c)), 6) as bare_nuclei from c"""),
    # item sets
    "frequent_items": _with(["v_ports", "v_size"], """
        select item, count(*) as n from v_ports group by item
        having count(*) * 1000 > 150 * (select baskets from v_size)"""),
    "frequent_pairs": _with(["v_pairs", "v_size"], """
        select item_1, item_2, n from v_pairs where n * 1000 > 22 * (select baskets from v_size)"""),
    "frequent_triples": _with(["v_triples", "v_size"], """
        select item_1, item_2, item_3, n from v_triples where n * 10000 > 33 * (select baskets from v_size)"""),
    "frequent_port_sets": _with(["v_pairs", "v_triples", "v_size"], """
        select concat_ws(',', item_1, item_2) as items, cast(2 as bigint) as size, n
        from v_pairs where n * 10000 > 33 * (select baskets from v_size)
        union all
        select concat_ws(',', item_1, item_2, item_3) as items, cast(3 as bigint) as size, n
        from v_triples where n * 10000 > 33 * (select baskets from v_size)"""),
    "frequent_sets_of_four": _with(["v_fours", "v_size"], """
        select concat_ws(',', item_1, item_2, item_3, item_4) as items, cast(4 as bigint) as size, n
        from v_fours where n * 10000 > 6 * (select baskets from v_size)"""),
    "fpgrowth_itemsets": _with(["v_ports", "v_pairs", "v_triples", "v_size"], """
        select items, size, n from (
            select item as items, cast(1 as bigint) as size, count(*) as n from v_ports group by item
            union all
            select concat_ws(',', item_1, item_2), cast(2 as bigint), n from v_pairs
            union all
            select concat_ws(',', item_1, item_2, item_3), cast(3 as bigint), n from v_triples)
        where n * 10000 > 33 * (select baskets from v_size)"""),
    # evaluation
    "rmse_metric": _with(["v_ratings", "v_stats"], """
        select round(sqrt(avg((Rating - AvgRating) * (Rating - AvgRating))), 6) as rmse
        from v_ratings join v_stats using (MovieID)"""),
    "f1_weighted": _with(["v_biopsies"], """
        , g as (select class, case when clump > 25 then 4 else 2 end as guess from v_biopsies)
        , f as (select c.class, (select count(*) from g where g.class = c.class) as support,
            (select count(*) from g where g.guess = c.class) as predicted,
            (select count(*) from g where g.class = c.class and g.guess = c.class) as hit
            from (select distinct class from g) c)
        select round(sum(support * 2.0::double * hit / (support + predicted)) / sum(support), 6) as f1 from f"""),
    "grid_select_best": _with(["v_split"], """
        , s as (select MovieID, sum(Rating) as s, count(*) as n from v_split where bucket < 3 group by MovieID)
        , level as (select sum(s) / sum(n) as mu from s)
        , e as (select reg, bucket,
                round(sqrt(avg(power(Rating - (s + reg * mu) / (n + reg), 2))), 6) as error
            from v_split join s using (MovieID), level, (select unnest([1, 10, 100]) as reg)
            where bucket >= 3 group by reg, bucket)
        , m as (select reg, max(error) filter (bucket = 3) as val_rmse, max(error) filter (bucket = 4) as test_rmse
            from e group by reg)
        , b as (select reg as best from m order by val_rmse, reg limit 1)
        select cast(reg as integer) as reg, val_rmse, reg = best as is_best,
            case when reg = best then test_rmse end as test_rmse from m, b"""),
    "cluster_profile": _with(["v_scanners"], """
        select numports as cluster, count(*) as size, sum(cast(mirai as integer)) / count(*) as mirai_ratio,
            sum(cast(zmap as integer)) / count(*) as zmap_ratio,
            sum(cast(masscan as integer)) / count(*) as masscan_ratio
        from v_scanners group by numports"""),
    "cluster_features": _with(["v_hot_counts"], "select cluster, feature, n from v_hot_counts"),
    "cluster_dominant_feature": _with(["v_hot_counts", "v_scanners"], """
        , z as (select numports as cluster, count(*) as size from v_scanners group by numports)
        , d as (select cluster, feature, n,
            row_number() over (partition by cluster order by n desc, feature) as place from v_hot_counts)
        select cluster, feature, n, n / size as share from d join z using (cluster) where place = 1"""),
    "cluster_sizes": "select label, count(*) as size from embeddings group by label",
    "cluster_means": _with(["v_means"], """
        select label, cast(dim as bigint) as dim, round(value, 6) as value from v_means"""),
    "nearest_centroid": _with(["v_dims", "v_means"], """
        , d as (select vec_id, m.label as cluster, sum((x - value) * (x - value)) as distance
            from v_dims join v_means m using (dim) group by vec_id, m.label)
        select vec_id, cluster, round(distance, 6) as distance from d
        qualify row_number() over (partition by vec_id order by distance, cluster) = 1"""),
    "silhouette": """
        with p as (select a.vec_id, a.label as own, b.label as other,
                sum(power(list_distance(a.e, b.e), 2)) as total, count(*) as n
            from (select vec_id, label, embedding::double[] as e from embeddings) a,
                (select vec_id, label, embedding::double[] as e from embeddings) b
            group by 1, 2, 3)
        , s as (select vec_id, max(total / (n - 1)) filter (own = other and n > 1) as a,
            min(total / n) filter (own <> other) as b from p group by vec_id)
        select round(avg(case when a is null then 0 else (b - a) / greatest(a, b) end), 6) as silhouette from s""",
    # models whose arithmetic SQL can write out
    "als_equations": _als_sql(seed=37, reg=0.1, iters=2),
    "kmeans_lloyd": _lloyd_sql(k=10, rounds=5),
    "tree_first_split": _with(["v_biopsies"], """
        , t as (select * from v_biopsies where ('0x' || substr(md5(concat_ws(':', id, line, '1234')), 1, 8))::bigint % 10 < 7)
        , v as (unpivot (select class, clump::double as clump, cell_size::double as cell_size, mitoses::double as mitoses from t)
            on clump, cell_size, mitoses into name feature value x)
        , c as (select feature, x, count(*) as n, count(*) filter (class = 4) as n4 from v group by all)
        , s as (select feature, (x + lead(x) over w) / 2 as threshold, sum(n) over w as ln, sum(n4) over w as l4,
                sum(n) over (partition by feature) as n, sum(n4) over (partition by feature) as n4
            from c window w as (partition by feature order by x))
        , g as (select feature, threshold, 1 - (n4 / n) ** 2 - (1 - n4 / n) ** 2 as impurity, ln / n as share,
                1 - (l4 / ln) ** 2 - (1 - l4 / ln) ** 2 as left_gini,
                1 - ((n4 - l4) / (n - ln)) ** 2 - (1 - (n4 - l4) / (n - ln)) ** 2 as right_gini
            from s where threshold is not null and ln >= 2 and n - ln >= 2)
        select feature, round(threshold, 6) as threshold,
            round(impurity - share * left_gini - (1 - share) * right_gini, 6) as gain, round(impurity, 6) as impurity
        from g order by impurity - share * left_gini - (1 - share) * right_gini desc limit 1"""),
    # what the tables alone say about fitted models
    "als_predict_keys": """
        with i as (select o_custkey as UserID, l_suppkey as ItemID, sum(l_quantity) / count(*) as Rating
            from lineitem join orders on l_orderkey = o_orderkey group by all)
        , b as (select *, ('0x' || substr(md5(concat_ws(':', UserID, ItemID, '137')), 1, 8))::bigint % 5 < 4 as train from i)
        select UserID, ItemID, round(Rating, 6) as Rating from b
        where not train and UserID in (select UserID from b where train) and ItemID in (select ItemID from b where train)""",
    "als_recommend_users": """
        with u as (select distinct o_custkey as UserID from lineitem join orders on l_orderkey = o_orderkey)
        , m as (select least(3, count(distinct l_suppkey)) as n from lineitem)
        select UserID, n, n as n_items, n as n_known from u, m""",
    "tree_predict_classes": _with(["v_biopsies"], """
        select id, line, class, true as one_name from v_biopsies
        where ('0x' || substr(md5(concat_ws(':', id, line, '1234')), 1, 8))::bigint % 10 >= 7"""),
    "tree_reloaded": _with(["v_biopsies"], """
        select id, line, class, true as same from v_biopsies
        where ('0x' || substr(md5(concat_ws(':', id, line, '1234')), 1, 8))::bigint % 10 >= 7"""),
    "tree_rules_cover": "select count(*) as n_rows, count(*) as n_one_rule, count(*) as n_same from lineitem",
    "kmeans_nearest": """
        select count(*) as n_points, 0::bigint as n_other_nearer, count(*) as n_sized from embeddings""",
    "kmeans_centers_shape": """
        with d as (select unnest(embedding) as x, unnest(range(len(embedding))) as dim from embeddings)
        select cast(dim as bigint) as dim, 10::bigint as n_clusters, round(sum(x::double), 2) as total from d group by dim""",
    "kmeans_mixed_sizes": _with(["v_scanners"], """
        select count(*) as n_rows, count(distinct scanner) as n_scanners, 0::bigint as n_out_of_range from v_scanners"""),
    "kmeans_thermo_totals": _with(["v_scanners"], """
        select count(*) as n_rows, count(*) filter (mirai) as mirai, count(*) filter (zmap) as zmap,
            count(*) filter (masscan) as masscan from v_scanners"""),
    "mlp_predict_keys": """
        select vec_id, cast(label as bigint) as label, true as in_range from embeddings
        where ('0x' || substr(md5(concat_ws(':', vec_id, '1')), 1, 8))::bigint % 5 >= 4""",
    "mlp_reloaded": """
        select vec_id, cast(label as bigint) as label, true as in_range, true as same from embeddings
        where ('0x' || substr(md5(concat_ws(':', vec_id, '1')), 1, 8))::bigint % 5 >= 4""",
    # streaming: the same counts as over the whole table
    "stream_prefix_counts": _with(["v_tags"], "select token, count(*) as n from v_tags group by token"),
}
# The same rows by another way.
ORACLE |= {
    "event_time_trend": ORACLE["two_period_trend"],
    "heavy_hashtags": ORACLE["top_k_hashtags"],
    "skew_ratings_join": ORACLE["ratings_join_movies"],
    "vertical_port_sets": ORACLE["frequent_port_sets"],
    "distinct_users_since": """
        with d as (select distinct cast(ts as date) as day from events)
        , l as (select user_id, max(cast(ts as date)) as last from events group by user_id)
        select cast(day as varchar) as day, count(user_id) as n, true as within_bound from d left join l on last >= day group by day""",
}
