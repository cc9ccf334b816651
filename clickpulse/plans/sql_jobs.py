"""Jobs Q1-Q4 written as Spark SQL over temp views (for users who prefer SQL).

``register_views`` names the input DataFrames ``user_visit_action``,
``user_info``, ``city_info`` and ``product_info``; the SQL below then runs as
written, with the SQL functions from ``functions/sql.py``. Catalyst plans these
exactly like the DataFrame operators (same pushdown, partial aggregates,
``WindowGroupLimit``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickpulse.functions.sql import register_share_function, register_sql_functions
from clickpulse.operators.area import area_city_clicks
from clickpulse.operators.jumps import session_next_page


def register_views(visits: DataFrame, users: DataFrame, cities: DataFrame, products: DataFrame) -> None:
    register_sql_functions(visits.sparkSession)
    visits.createOrReplaceTempView("user_visit_action")
    users.createOrReplaceTempView("user_info")
    cities.createOrReplaceTempView("city_info")
    products.createOrReplaceTempView("product_info")
    area_city_clicks(visits, cities).createOrReplaceTempView("area_city_clicks")
    register_share_function(visits.sparkSession)


def _lit(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def category_top_n_sql(spark: SparkSession, task_id: str, start_date=None, end_date=None, start_age=None,
                       end_age=None, n: int = 10) -> DataFrame:
    """Q1 in SQL. Empty/None parameters add no predicate; the age range is inclusive."""
    when = [f"date {op} DATE {_lit(x)}" for op, x in ((">=", start_date), ("<=", end_date)) if x not in (None, "")]
    ages = [f"age {op} {int(x)}" for op, x in ((">=", start_age), ("<=", end_age)) if x not in (None, "")]
    # Each filter stands beside its own scan; the users then only lend their key.
    visits = "SELECT * FROM user_visit_action" + (f" WHERE {' AND '.join(when)}" if when else "")
    people = "SELECT user_id FROM user_info" + (f" WHERE {' AND '.join(ages)}" if ages else "")
    spark.sql(f"SELECT * FROM ({visits}) JOIN ({people}) USING (user_id)").createOrReplaceTempView("filtered_visit_action")
    return spark.sql(f"""
        WITH classified AS (
          SELECT CASE
            WHEN click_category_id <> -1
              THEN array(named_struct('action', 'click', 'category', CAST(click_category_id AS STRING)))
            WHEN order_category_ids IS NOT NULL
              THEN transform(cp_split_ids(order_category_ids), c -> named_struct('action', 'order', 'category', c))
            WHEN pay_category_ids IS NOT NULL
              THEN transform(cp_split_ids(pay_category_ids), c -> named_struct('action', 'pay', 'category', c))
          END AS acts
          FROM filtered_visit_action
        ),
        acts AS (SELECT inline(acts) FROM classified)
        SELECT {_lit(task_id)} AS task_id, category,
               count_if(action = 'click') AS click, count_if(action = 'order') AS `order`,
               count_if(action = 'pay') AS pay
        FROM acts GROUP BY category
        ORDER BY click DESC, `order` DESC, pay DESC, category
        LIMIT {int(n)}
    """)


def category_session_top_n_sql(spark: SparkSession, task_id: str, top_categories_view: str = "category_top10",
                               n: int = 10) -> DataFrame:
    """Q2 in SQL over ``filtered_visit_action`` (made by ``category_top_n_sql``) and the top-category view.

    The top list is at most a top-n: a broadcast semi join. ``row_number <= n`` becomes a
    ``WindowGroupLimit`` that trims each task before the shuffle.
    """
    return spark.sql(f"""
        SELECT {_lit(task_id)} AS task_id, category, session_id, n FROM (
          SELECT v.click_category_id AS category, v.session_id, count(*) AS n,
                 row_number() OVER (PARTITION BY v.click_category_id
                                    ORDER BY count(*) DESC, v.session_id) AS rn
          FROM filtered_visit_action v
          LEFT SEMI JOIN (SELECT /*+ BROADCAST(t) */ CAST(category AS BIGINT) AS category
                          FROM {top_categories_view} t) t
            ON v.click_category_id = t.category
          GROUP BY v.click_category_id, v.session_id
        ) WHERE rn <= {int(n)}
    """)


def page_jump_ratio_sql(spark: SparkSession, task_id: str, flow: str = "1,2,3,4,5,6,7") -> DataFrame:
    """Q3 in SQL over the view ``next_pages``, which the sliced ``jumps.session_next_page`` provides."""
    pages = [p.strip() for p in flow.split(",") if p.strip()]
    session_next_page(spark.table("user_visit_action")).createOrReplaceTempView("next_pages")
    steps = ", ".join(f"({int(a)}, {int(b)})" for a, b in zip(pages, pages[1:]))
    return spark.sql(f"""
        WITH steps AS (SELECT DISTINCT * FROM VALUES {steps} AS t(here, there)),
        jumps AS (SELECT page_id, next_page, count(*) AS n FROM next_pages GROUP BY page_id, next_page),
        seen AS (SELECT page_id, count(*) AS n FROM user_visit_action GROUP BY page_id)
        SELECT {_lit(task_id)} AS task_id, concat(here, '-', there) AS jump,
               CAST(jumps.n AS DOUBLE) / CAST(coalesce(seen.n, 1) AS DOUBLE) AS ratio
        FROM steps JOIN jumps ON jumps.page_id = here AND jumps.next_page = there
        LEFT JOIN seen ON seen.page_id = here
    """)


def area_product_top_n_sql(spark: SparkSession, task_id: str, n: int = 3) -> DataFrame:
    """Q4 in SQL: rank filter after the window, city share via ``cp_city_share``."""
    return spark.sql(f"""
        WITH counted AS (
          SELECT city_id, click_product_id AS product_id, count(*) AS n
          FROM user_visit_action WHERE click_product_id > 0 GROUP BY ALL
        ),
        per_city AS (
          SELECT area, product_id, city_name, sum(n) AS n
          FROM counted JOIN (SELECT city_id, area, city_name FROM city_info) USING (city_id)
          GROUP BY ALL
        ),
        ranked_city AS (
          SELECT *, row_number() OVER (PARTITION BY area, product_id
                                       ORDER BY city_name IS NULL, n DESC, city_name) AS rn,
                    sum(n) OVER (PARTITION BY area, product_id) AS total
          FROM per_city
        ),
        per_product AS (
          SELECT area, product_id, CAST(max(total) AS BIGINT) AS total,
                 transform(array_sort(collect_list(CASE WHEN city_name IS NOT NULL
                                                        THEN struct(rn, city_name, n) END)),
                           x -> struct(x.city_name AS city_name, x.n AS n)) AS top
          FROM ranked_city WHERE rn <= 2 GROUP BY area, product_id
        ),
        ranked AS (
          SELECT p.*, pi.product_name, rank() OVER (PARTITION BY p.area ORDER BY p.total DESC) AS rk
          FROM per_product p JOIN product_info pi ON p.product_id = pi.product_id
        )
        SELECT {_lit(task_id)} AS task_id, area, product_name, total AS product_count,
               cp_city_share(top, total) AS city_click_ratio
        FROM ranked WHERE rk <= {int(n)}
    """)
