"""SQL for DuckDB, one statement for each registered query that plain SQL can express.

Every statement starts with the mapping of the test tables to operational tables, written independently of the
Spark code. Sums are exact integers (cents) and means are rounded half up from integers, as in the Spark code.
"""

from __future__ import annotations


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"(pow(sin(radians({lat2}-{lat1})/2),2)"
        f"+cos(radians({lat1}))*cos(radians({lat2}))*pow(sin(radians({lon2}-{lon1})/2),2))"
    )
    return f"(atan2(sqrt({a}),sqrt(1-{a}))*12742.0)"


def units(x: str, per_one: int = 100) -> str:
    return f"round(({x})*{per_one})::HUGEINT"


def esum(x: str, per_one: int = 100) -> str:
    return f"(sum({units(x, per_one)})::DOUBLE/{per_one})"


def half_up(num: str, den: str) -> str:
    return f"(sign({num})*((2*abs({num})+({den}))//nullif(2*({den}),0)))"


def emean(x: str, digits: int, per_one: int = 100) -> str:
    scale = 10**digits
    num = f"(sum({units(x, per_one)})*{scale})"
    return f"({half_up(num, f'(count({x})*{per_one})')}::DOUBLE/{scale})"


MAPPING = f"""
places AS (
  SELECT n_nationkey, n_nationkey+1 AS location_key, n_name AS zone, 'Zone '||n_nationkey AS zone_name,
         14.5::DOUBLE+((n_nationkey*7)%25)*0.013::DOUBLE AS lat,
         -90.7::DOUBLE+((n_nationkey*11)%25)*0.011::DOUBLE AS lon
  FROM nation),
zones AS (
  SELECT location_key, zone, zone_name, lat, lon FROM places
  WHERE n_nationkey IN (SELECT c_nationkey FROM customer)),
users AS (
  SELECT c_custkey AS id, c_name AS name, 'user'||c_custkey||'@example.com' AS email,
         CASE WHEN c_mktsegment='MACHINERY' THEN 'admin' ELSE 'customer' END AS role, zone, lat, lon
  FROM customer JOIN places ON c_nationkey=n_nationkey),
restaurants AS (
  SELECT s_suppkey AS id, s_name AS name, 'Street '||s_suppkey AS address, zone, lat, lon,
         (s_suppkey%50)::DOUBLE/10.0::DOUBLE AS rating
  FROM supplier JOIN places ON s_nationkey=n_nationkey),
categories AS (
  SELECT row_number() OVER (ORDER BY p_type) AS id, p_type AS name,
         'Products of type '||p_type AS description, substr(p_type,1,1) AS icon
  FROM (SELECT DISTINCT p_type FROM part)),
products AS (
  SELECT p_partkey AS id, p_name AS name, p_retailprice AS price, p_size%10<>0 AS available, c.id AS category_id
  FROM part JOIN categories c ON p_type=c.name),
o_orders AS (
  SELECT o_orderkey AS id, o_custkey AS user_id, restaurant_id,
         o_orderdate+to_seconds(o_orderkey*7919%86400) AS order_ts,
         CASE o_orderstatus WHEN 'F' THEN 'completed'
           WHEN 'O' THEN CASE o_orderkey%3 WHEN 0 THEN 'delivering' WHEN 1 THEN 'preparing' ELSE 'confirmed' END
           ELSE CASE o_orderkey%2 WHEN 0 THEN 'cancelled' ELSE 'pending' END END AS status,
         o_totalprice AS total,
         CASE WHEN o_orderkey%10<5 THEN 'card' WHEN o_orderkey%10<8 THEN 'cash' ELSE 'wallet' END AS payment_method
  FROM orders LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS restaurant_id FROM lineitem GROUP BY 1)
    ON o_orderkey=l_orderkey),
deliveries AS (
  SELECT order_id, courier_id, dest_zone, distance_km, eta_min::INT AS eta_min,
         CASE WHEN status='completed' THEN order_ts+to_minutes((eta_min+order_id%14-3)::BIGINT) END AS delivered_ts,
         status
  FROM (SELECT *, trunc(distance_km*4)::BIGINT+5+order_id%11 AS eta_min
    FROM (SELECT o.id AS order_id, o.id%12+1 AS courier_id, u.zone AS dest_zone, o.status, o.order_ts,
                 round({haversine('r.lat', 'r.lon', 'u.lat', 'u.lon')},2) AS distance_km
          FROM o_orders o JOIN users u ON u.id=o.user_id LEFT JOIN restaurants r ON r.id=o.restaurant_id
          WHERE o.status IN ('completed','delivering')))),
couriers AS (
  SELECT id, 'courier_'||id AS name,
         CASE id%3 WHEN 0 THEN 'moto' WHEN 1 THEN 'bicicleta' ELSE 'carro' END AS vehicle, p.zone AS base_zone
  FROM (SELECT DISTINCT courier_id AS id FROM deliveries) LEFT JOIN places p ON p.n_nationkey=id*2),
items AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, l_quantity::INT AS quantity,
         l_extendedprice/l_quantity::INT AS unit_price, l_extendedprice AS line_total FROM lineitem)
"""

STAR = """
dim_date AS (
  SELECT (year(d)*10000+month(d)*100+day(d))::INT AS date_key, d AS full_date, year(d)::INT AS year,
         quarter(d)::INT AS quarter, CASE WHEN month(d)<=6 THEN 1 ELSE 2 END AS semester, month(d)::INT AS month,
         monthname(d) AS month_name, weekofyear(d)::INT AS week_of_year, day(d)::INT AS day_of_month,
         (dayofweek(d)+1)::INT AS day_of_week, dayname(d) AS day_name, dayofweek(d) IN (0,6) AS is_weekend
  FROM (SELECT unnest(generate_series(min(order_ts)::DATE, max(order_ts)::DATE, INTERVAL 1 DAY))::DATE AS d
        FROM o_orders)),
dim_time AS (
  SELECT h::INT AS time_key, h::INT AS hour, lpad(h::VARCHAR,2,'0')||':00' AS time_label,
         CASE WHEN h<=5 THEN 'madrugada' WHEN h<=11 THEN 'mañana' WHEN h<=14 THEN 'almuerzo'
              WHEN h<=17 THEN 'tarde' WHEN h<=22 THEN 'cena' ELSE 'noche' END AS time_of_day
  FROM range(24) t(h)),
dim_category AS (
  SELECT row_number() OVER (ORDER BY id) AS category_key, id AS category_id, name AS category_name, description, icon
  FROM categories),
dim_product AS (
  SELECT row_number() OVER (ORDER BY p.id) AS product_key, p.id AS product_id, p.name AS product_name,
         c.category_key, c.category_name, p.price::DOUBLE AS unit_price, p.available
  FROM products p JOIN dim_category c USING (category_id)),
dim_customer AS (
  SELECT row_number() OVER (ORDER BY id) AS customer_key, id AS user_id, name AS user_name, email, zone, lat, lon
  FROM users WHERE role='customer'),
dim_restaurant AS (
  SELECT row_number() OVER (ORDER BY id) AS restaurant_key, id AS restaurant_id, name AS rest_name, address, zone,
         lat, lon, rating FROM restaurants),
dim_location AS (SELECT location_key::INT AS location_key, zone, zone_name, lat, lon FROM zones),
dim_courier AS (
  SELECT row_number() OVER (ORDER BY id) AS courier_key, id AS courier_id, name AS courier_name, vehicle, base_zone
  FROM couriers),
fact_orders AS (
  SELECT o.id::BIGINT AS order_key, o.id AS order_id, strftime(order_ts,'%Y%m%d')::INT AS date_key,
         hour(order_ts)::INT AS time_key, customer_key, restaurant_key,
         coalesce(location_key,-1) AS location_key, coalesce(courier_key,-1) AS courier_key, o.status,
         payment_method, total, coalesce(item_count,0) AS item_count, distance_km, eta_min,
         trunc((epoch(delivered_ts)-epoch(order_ts))/60)::INT AS delivery_time_min,
         o.status IN ('completed','delivering') AS is_delivered, year(order_ts)::INT AS year,
         month(order_ts)::INT AS month
  FROM o_orders o LEFT JOIN deliveries d ON o.id=d.order_id LEFT JOIN dim_customer c USING (user_id)
  LEFT JOIN dim_restaurant r USING (restaurant_id) LEFT JOIN dim_location l ON l.zone=d.dest_zone
  LEFT JOIN dim_courier k ON k.courier_id=d.courier_id
  LEFT JOIN (SELECT order_id, count(*) AS item_count FROM items GROUP BY 1) n ON n.order_id=o.id),
fact_order_items AS (
  SELECT row_number() OVER (ORDER BY i.order_id, i.product_id, i.quantity, i.line_total) AS item_key, i.order_id,
         strftime(order_ts,'%Y%m%d')::INT AS date_key, hour(order_ts)::INT AS time_key, product_key, category_key,
         restaurant_key, customer_key, i.quantity, i.unit_price, i.line_total,
         year(order_ts)::INT AS year, month(order_ts)::INT AS month
  FROM items i JOIN o_orders o ON o.id=i.order_id JOIN dim_product p USING (product_id)
  JOIN dim_restaurant r USING (restaurant_id) JOIN dim_customer c USING (user_id))
"""

YM = "d.year||'-'||lpad(d.month::VARCHAR,2,'0')"

CUBES = f"""
cube_revenue_month_category AS (
  SELECT d.year, d.month, d.month_name, {YM} AS year_month, c.category_name,
         count(DISTINCT f.order_id) AS order_count, sum(f.quantity)::BIGINT AS units_sold,
         {esum('f.line_total')} AS revenue, round(avg(f.line_total/f.quantity),2) AS avg_unit_price
  FROM fact_order_items f JOIN dim_date d USING (date_key) JOIN dim_category c USING (category_key)
  GROUP BY ALL),
cube_orders_by_zone AS (
  SELECT l.zone, l.zone_name, l.lat, l.lon, d.year, d.month, count(*) AS order_count,
         sum(CASE WHEN f.is_delivered THEN 1 ELSE 0 END)::BIGINT AS delivered_count,
         {emean('f.distance_km', 2)} AS avg_distance_km, {emean('f.delivery_time_min', 1, 1)} AS avg_delivery_min,
         {esum('f.total')} AS total_revenue, {emean('f.total', 2)} AS avg_ticket
  FROM fact_orders f JOIN dim_date d USING (date_key) JOIN dim_location l USING (location_key)
  GROUP BY l.zone, l.zone_name, l.lat, l.lon, d.year, d.month),
cube_order_status AS (
  SELECT d.year, d.month, d.month_name, {YM} AS year_month, f.status, f.payment_method, count(*) AS order_count,
         {esum('f.total')} AS revenue, {emean('f.total', 2)} AS avg_ticket
  FROM fact_orders f JOIN dim_date d USING (date_key)
  GROUP BY d.year, d.month, d.month_name, f.status, f.payment_method),
cube_peak_hours AS (
  SELECT t.hour, t.time_label, t.time_of_day, d.day_of_week, d.day_name, d.is_weekend, count(*) AS order_count,
         {esum('f.total')} AS revenue, {emean('f.total', 2)} AS avg_ticket,
         {emean('f.item_count', 1, 1)} AS avg_items_per_order
  FROM fact_orders f JOIN dim_time t USING (time_key) JOIN dim_date d USING (date_key)
  GROUP BY t.hour, t.time_label, t.time_of_day, d.day_of_week, d.day_name, d.is_weekend),
cube_product_ranking AS (
  SELECT p.product_name, p.category_name, p.unit_price AS current_price,
         count(DISTINCT f.order_id) AS orders_containing, sum(f.quantity)::BIGINT AS units_sold,
         {esum('f.line_total')} AS total_revenue, round(avg(f.unit_price),2) AS avg_sold_price,
         {half_up('sum(' + units('f.line_total') + ')', 'sum(f.quantity)')}::DOUBLE/100 AS revenue_per_unit
  FROM fact_order_items f JOIN dim_product p USING (product_key)
  GROUP BY p.product_name, p.category_name, p.unit_price),
cube_courier_performance AS (
  SELECT c.courier_name, c.vehicle, c.base_zone, count(*) AS total_assignments,
         sum(CASE WHEN f.status='completed' THEN 1 ELSE 0 END)::BIGINT AS completed,
         sum(CASE WHEN f.status='delivering' THEN 1 ELSE 0 END)::BIGINT AS in_transit,
         {emean('f.distance_km', 2)} AS avg_distance_km, {emean('f.eta_min', 1, 1)} AS avg_eta_min,
         {emean('f.delivery_time_min', 1, 1)} AS avg_real_time_min,
         round(avg(f.delivery_time_min)-avg(f.eta_min),1) AS avg_delay_min,
         {esum('f.total')} AS total_revenue_handled
  FROM fact_orders f JOIN dim_courier c USING (courier_key) WHERE f.courier_key>0
  GROUP BY c.courier_name, c.vehicle, c.base_zone)
"""

MARTS = f"""
mart_trends AS (
  SELECT * EXCLUDE (avg_unit_price),
         sum({units('revenue')}) OVER (PARTITION BY category_name ORDER BY year, month
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::DOUBLE/100 AS cumulative_revenue,
         rank() OVER (PARTITION BY year, month ORDER BY revenue DESC)::INT AS revenue_rank_in_month
  FROM cube_revenue_month_category),
mart_peak_hours AS (
  SELECT * RENAME (avg_items_per_order AS avg_items), rank() OVER (ORDER BY order_count DESC)::INT AS global_rank
  FROM cube_peak_hours),
monthly AS (
  SELECT d.year, d.month, d.month_name, {YM} AS year_month, count(*) AS order_count, {esum('f.total')} AS revenue,
         {emean('f.total', 2)} AS avg_ticket, {emean('f.item_count', 2, 1)} AS avg_items_per_order,
         count(DISTINCT f.customer_key) AS unique_customers
  FROM fact_orders f JOIN dim_date d USING (date_key) WHERE f.status='completed'
  GROUP BY d.year, d.month, d.month_name),
mart_monthly_growth AS (
  SELECT *, round((order_count-lag(order_count) OVER w)/nullif(lag(order_count) OVER w,0)::DOUBLE*100,2)
              AS order_count_pct_change,
         round((revenue-lag(revenue) OVER w)/nullif(lag(revenue) OVER w,0)*100,2) AS revenue_pct_change,
         sum({units('revenue')}) OVER (ORDER BY year, month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              ::DOUBLE/100 AS cumulative_revenue
  FROM monthly WINDOW w AS (ORDER BY year, month)),
mart_executive_summary AS (
  SELECT count(*) AS total_orders, sum(CASE WHEN status='completed' THEN 1 END)::BIGINT AS completed_orders,
         {esum('total')} AS total_revenue, {emean('total', 2)} AS avg_ticket,
         count(DISTINCT customer_key) AS unique_customers, count(DISTINCT restaurant_key) AS active_restaurants
  FROM fact_orders)
"""


def _sql(body: str, *parts: str) -> str:
    ctes = ",".join(p.strip() for p in (MAPPING, *parts))
    return f"WITH RECURSIVE {ctes}\n{body}"


def warehouse_oracles() -> dict[str, str]:
    star = lambda body: _sql(body, STAR)
    cube = lambda body: _sql(body, STAR, CUBES)
    mart = lambda body: _sql(body, STAR, CUBES, MARTS)
    out = {
        name: star(f"SELECT * FROM {name}")
        for name in (
            "dim_date", "dim_category", "dim_product", "dim_customer", "dim_restaurant", "dim_location",
            "dim_courier", "fact_orders", "fact_order_items",
        )
    }
    out["items_per_order"] = _sql("SELECT order_id, count(*) AS item_count FROM items GROUP BY 1")
    for name in (
        "cube_revenue_month_category", "cube_orders_by_zone", "cube_order_status", "cube_peak_hours",
        "cube_product_ranking", "cube_courier_performance",
    ):
        out[name] = cube(f"SELECT * FROM {name}")
    for name in ("mart_trends", "mart_peak_hours", "mart_monthly_growth", "mart_executive_summary"):
        out[name] = mart(f"SELECT * FROM {name}")
    out["busiest_hours"] = mart("SELECT * FROM mart_peak_hours ORDER BY global_rank, day_of_week, hour LIMIT 10")

    revenue = "sum(round(revenue*100)::HUGEINT)::DOUBLE/100 AS revenue"
    by_cat, by_zone, by_status = "cube_revenue_month_category", "cube_orders_by_zone", "cube_order_status"
    out["board_revenue_by_month_category"] = cube(
        f"SELECT year_month, category_name, {revenue} FROM {by_cat} GROUP BY 1,2")
    out["board_revenue_by_category"] = cube(
        f"SELECT category_name, {revenue} FROM {by_cat} GROUP BY 1")
    out["board_orders_units_by_month"] = cube(
        f"SELECT year_month, sum(order_count)::BIGINT AS orders, sum(units_sold)::BIGINT AS units "
        f"FROM {by_cat} GROUP BY 1")
    out["board_orders_by_zone"] = cube(
        f"SELECT zone_name, sum(order_count)::BIGINT AS orders FROM {by_zone} GROUP BY 1")
    out["board_revenue_by_zone"] = cube(
        f"SELECT zone_name, sum(round(total_revenue*100)::HUGEINT)::DOUBLE/100 AS revenue "
        f"FROM {by_zone} GROUP BY 1")
    out["board_delivery_by_zone"] = cube(
        f"SELECT zone_name, sum(round(avg_distance_km*100)::HUGEINT)::DOUBLE/(count(avg_distance_km)*100)::DOUBLE "
        f"AS avg_km, sum(round(avg_delivery_min*10)::HUGEINT)::DOUBLE/(count(avg_delivery_min)*10)::DOUBLE AS avg_min "
        f"FROM {by_zone} GROUP BY 1")
    out["board_status_over_time"] = cube(
        f"SELECT year_month, status, sum(order_count)::BIGINT AS orders FROM {by_status} GROUP BY 1,2")
    out["board_status_distribution"] = cube(
        f"SELECT status, orders, {half_up('(orders*10000)', 'sum(orders) OVER ()')}::DOUBLE/100 AS percent "
        f"FROM (SELECT status, sum(order_count)::BIGINT AS orders FROM {by_status} GROUP BY 1)")
    out["board_revenue_by_status_month"] = cube(
        f"SELECT year_month, status, {revenue} FROM {by_status} GROUP BY 1,2")
    return out



CONTAINS = """
nodes_product AS (
  SELECT p.id AS prod_id, p.name, p.price, p.available, c.name AS category
  FROM products p JOIN categories c ON c.id=p.category_id),
contains AS (
  SELECT order_id, product_id AS prod_id, quantity, unit_price, line_total
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id, product_id
                                     ORDER BY line_total DESC, quantity DESC, unit_price DESC) AS rn FROM items)
  WHERE rn=1 AND order_id IN (SELECT id FROM o_orders) AND product_id IN (SELECT prod_id FROM nodes_product)),
delivered_to AS (
  SELECT order_id, dest_zone AS zone, distance_km, eta_min::DOUBLE AS eta_min, status
  FROM deliveries WHERE dest_zone IN (SELECT zone FROM zones)),
visits AS (SELECT DISTINCT user_id, restaurant_id FROM o_orders WHERE restaurant_id IS NOT NULL),
visitors AS (
  SELECT user_id, restaurant_id AS via_restaurant,
         row_number() OVER (PARTITION BY restaurant_id ORDER BY user_id)-1 AS recommended_by,
         count(*) OVER (PARTITION BY restaurant_id)-row_number() OVER (PARTITION BY restaurant_id ORDER BY user_id) AS recommends
  FROM visits)
"""

NETWORK = f"""
network AS (
  SELECT a.zone AS src, b.zone AS dst, round({haversine('least_a.lat', 'least_a.lon', 'least_b.lat', 'least_b.lon')},2) AS km
  FROM zones a JOIN zones b ON a.zone<>b.zone
  JOIN zones least_a ON least_a.location_key=least(a.location_key,b.location_key)
  JOIN zones least_b ON least_b.location_key=greatest(a.location_key,b.location_key)),
steps AS (
  SELECT src AS node, dst AS nxt, km AS leg FROM network UNION ALL SELECT zone, zone, NULL FROM zones),
relaxed AS (
  SELECT zone AS src, zone AS dst, {{'km': 0.0::DOUBLE, 'hops': 0, 'route': [zone], 'costs': [0.0::DOUBLE]}} AS p, 0 AS k
  FROM zones
  UNION ALL
  SELECT s.src, e.nxt,
         min(CASE WHEN e.leg IS NULL THEN s.p ELSE
             {{'km': s.p.km+e.leg, 'hops': s.p.hops+1, 'route': list_append(s.p.route, e.nxt),
              'costs': list_append(s.p.costs, s.p.km+e.leg)}} END), s.k+1
  FROM relaxed s JOIN steps e ON e.node=s.dst WHERE s.k<24 GROUP BY s.src, e.nxt, s.k),
best AS (SELECT src, dst, p FROM relaxed WHERE k=24)
"""

# Breadth-first levels from one zone: fewest edges, then the first route by names.
HOPS = """
levels AS (
  SELECT zone AS node, {'hops': 0, 'route': [zone], 'legs': []::DOUBLE[]} AS p, 0 AS k FROM zones WHERE zone='NATION_1'
  UNION ALL
  SELECT e.nxt, min(CASE WHEN e.leg IS NULL THEN s.p ELSE
         {'hops': s.p.hops+1, 'route': list_append(s.p.route, e.nxt), 'legs': list_append(s.p.legs, e.leg)} END), s.k+1
  FROM levels s JOIN steps e ON e.node=s.node WHERE s.k<24 GROUP BY e.nxt, s.k)
"""

# The zone network without its long edges.
SPARSE = NETWORK.replace("network AS (", "everywhere AS (", 1).replace(
    "steps AS (", "network AS (SELECT * FROM everywhere WHERE km<=6.5),\nsteps AS (", 1)

# Merged recommendations: a pair of users has one edge, from the smaller id, with the restaurants that the two share.
MERGED = """
merged AS (
  SELECT a.user_id AS src, b.user_id AS dst, count(*) AS shared
  FROM visits a JOIN visits b ON a.restaurant_id=b.restaurant_id AND a.user_id<b.user_id GROUP BY 1,2),
degrees AS (
  SELECT user_id, coalesce(n,0)::BIGINT AS recommends FROM (SELECT DISTINCT user_id FROM visits)
  LEFT JOIN (SELECT src AS user_id, count(*) AS n FROM merged GROUP BY 1) USING (user_id))
"""

PAGERANK = """
pagerank AS (
  SELECT user_id AS id, 0.15::DOUBLE AS score, 0 AS k FROM degrees
  UNION ALL
  SELECT id, 0.15::DOUBLE+0.85::DOUBLE*sum(part), k+1
  FROM (
    SELECT m.dst AS id, p.k, p.score/w.recommends AS part
    FROM pagerank p JOIN merged m ON m.src=p.id JOIN degrees w ON w.user_id=p.id WHERE p.k<20
    UNION ALL SELECT id, k, 0 FROM pagerank WHERE k<20)
  GROUP BY id, k)
"""

DISPATCH = f"""
fleet AS (
  SELECT c.id AS courier_id, c.name, c.vehicle, c.base_zone, coalesce(z.lat, 14.60::DOUBLE) AS base_lat,
         coalesce(z.lon, -90.51::DOUBLE) AS base_lon
  FROM couriers c LEFT JOIN zones z ON z.zone=c.base_zone),
turns AS (SELECT *, row_number() OVER (ORDER BY courier_id)-1 AS turn, count(*) OVER () AS size FROM fleet),
pending AS (
  SELECT o.id AS order_id, z.zone AS dest_zone, z.lat AS dest_lat, z.lon AS dest_lon, u.name AS customer, o.total,
         (row_number() OVER (ORDER BY o.id)-1)//60+1 AS batch
  FROM o_orders o JOIN deliveries d ON d.order_id=o.id JOIN zones z ON z.zone=d.dest_zone JOIN users u ON u.id=o.user_id
  WHERE o.status IN ('pending','preparing','delivering')),
quotas AS (
  SELECT batch, ceil(count(*)::DOUBLE/(SELECT count(*) FROM fleet))::BIGINT AS quota FROM pending GROUP BY batch),
walk AS (
  SELECT batch, quota, 0::BIGINT AS step, []::BIGINT[] AS used, NULL::BIGINT AS courier_id, NULL::BIGINT AS seq,
         NULL::VARCHAR AS from_zone, {{'km': 0.0::DOUBLE, 'order_id': -1::BIGINT, 'zone': '', 'lat': 0.0::DOUBLE,
         'lon': 0.0::DOUBLE}} AS stop
  FROM quotas
  UNION ALL
  SELECT batch, quota, step+1, list_append(used, m.order_id), courier_id, seq, from_zone, m
  FROM (
    SELECT w.batch, w.quota, w.step, w.used, t.courier_id, w.step%w.quota+1 AS seq,
           CASE WHEN w.step%w.quota=0 THEN t.base_zone ELSE w.stop.zone END AS from_zone,
           min({{'km': {haversine("CASE WHEN w.step%w.quota=0 THEN t.base_lat ELSE w.stop.lat END",
                                  "CASE WHEN w.step%w.quota=0 THEN t.base_lon ELSE w.stop.lon END",
                                  "p.dest_lat", "p.dest_lon")},
                'order_id': p.order_id, 'zone': p.dest_zone, 'lat': p.dest_lat, 'lon': p.dest_lon}}) AS m
    FROM walk w JOIN turns t ON t.turn=(w.step//w.quota+(w.batch-1)*ceil(60/ceil(60.0/t.size))::BIGINT)%t.size
    JOIN pending p ON p.batch=w.batch AND NOT list_contains(w.used, p.order_id)
    GROUP BY ALL)),
routes AS (
  SELECT w.batch, w.stop.order_id AS order_id, p.dest_zone, p.customer, p.total, w.courier_id, w.seq::INT AS seq,
         w.from_zone, CASE WHEN w.from_zone=p.dest_zone THEN 0.0::DOUBLE ELSE coalesce(round(b.p.km*100)/100, 999.0::DOUBLE) END
           AS distance_km
  FROM walk w JOIN pending p ON p.order_id=w.stop.order_id
  LEFT JOIN best b ON b.src=w.from_zone AND b.dst=p.dest_zone WHERE w.step>0)
"""


def _on_curve(lat: str, lon: str) -> str:
    """Bits of the cell of a place, those of its latitude and longitude in turn."""
    cell = lambda x, span: f"least(floor(({x}+{span / 2}::DOUBLE)/{span}*65536), 65535)::BIGINT"
    return "(" + "+".join(
        f"((({cell(x, span)})>>{i})&1)*{1 << (2 * i + shift)}" for x, span, shift in ((lat, 180, 1), (lon, 360, 0)) for i in range(16)) + ")"


# Batches of twelve by month and neighbourhood, and couriers dealt to them along the same curve.
PLACE = DISPATCH.split("turns AS")[0] + f"""
lined AS (
  SELECT o.id AS order_id, z.zone AS dest_zone, z.lat AS dest_lat, z.lon AS dest_lon, u.name AS customer, o.total,
         date_trunc('month', o.order_ts)::DATE AS period, row_number() OVER (
           PARTITION BY date_trunc('month', o.order_ts) ORDER BY {_on_curve('z.lat', 'z.lon')}, o.id)-1 AS place
  FROM o_orders o JOIN deliveries d ON d.order_id=o.id JOIN zones z ON z.zone=d.dest_zone JOIN users u ON u.id=o.user_id
  WHERE o.status IN ('pending','preparing','delivering')),
periods AS (
  SELECT period, ceil(count(*)/12.0)::BIGINT AS parts, coalesce(sum(ceil(count(*)/12.0)::BIGINT) OVER (
    ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM lined GROUP BY period),
pending AS (SELECT *, place//12 AS part, before+place//12+1 AS batch FROM lined JOIN periods USING (period)),
couriers_lined AS (
  SELECT *, row_number() OVER (ORDER BY {_on_curve('base_lat', 'base_lon')}, courier_id)-1 AS no, count(*) OVER () AS size FROM fleet),
turns AS (
  SELECT c.*, b.batch, row_number() OVER (PARTITION BY b.batch ORDER BY c.courier_id)-1 AS turn
  FROM (SELECT DISTINCT batch, part, parts FROM pending) b JOIN couriers_lined c
  ON c.no>=b.part*c.size//b.parts AND c.no<greatest((b.part+1)*c.size//b.parts, b.part*c.size//b.parts+1)),
quotas AS (
  SELECT batch, ceil(count(*)::DOUBLE/(SELECT count(*) FROM turns t WHERE t.batch=p.batch))::BIGINT AS quota FROM pending p GROUP BY batch),
walk AS""" + DISPATCH.split("walk AS")[1].replace(
    "t.turn=(w.step//w.quota+(w.batch-1)*ceil(60/ceil(60.0/t.size))::BIGINT)%t.size", "t.batch=w.batch AND t.turn=w.step//w.quota")


def graph_oracles() -> dict[str, str]:
    graph = lambda body: _sql(body, CONTAINS)
    out = {
        "graph_users": _sql("SELECT id AS user_id, name, email, role, zone, lat, lon FROM users"),
        "graph_restaurants": _sql("SELECT id AS rest_id, name, address, zone, lat, lon, rating FROM restaurants"),
        "graph_products": graph("SELECT * FROM nodes_product"),
        "graph_couriers": _sql("SELECT id AS courier_id, name, vehicle, base_zone FROM couriers"),
        "graph_locations": _sql("SELECT zone, zone_name, lat, lon FROM zones"),
        "graph_orders": _sql(
            "SELECT id AS order_id, status, total, payment_method, strftime(order_ts,'%Y-%m-%d %H:%M:%S') AS order_ts "
            "FROM o_orders"),
        "graph_placed": _sql("SELECT DISTINCT user_id, o.id AS order_id FROM o_orders o JOIN users u ON u.id=user_id"),
        "graph_from_restaurant": _sql(
            "SELECT DISTINCT o.id AS order_id, restaurant_id AS rest_id "
            "FROM o_orders o JOIN restaurants r ON r.id=restaurant_id"),
        "graph_contains": graph("SELECT * FROM contains"),
        "graph_delivered_to": graph("SELECT * FROM delivered_to"),
        "graph_assigned": _sql("SELECT DISTINCT courier_id, order_id FROM deliveries WHERE courier_id IS NOT NULL"),
        "graph_recommends": graph("SELECT * FROM visitors"),
        "graph_label_counts": graph(
            "SELECT * FROM (SELECT 'User' AS label, count(*) AS nodes FROM users "
            "UNION ALL SELECT 'Restaurant', count(*) FROM restaurants "
            "UNION ALL SELECT 'Product', count(*) FROM nodes_product "
            "UNION ALL SELECT 'Courier', count(*) FROM couriers UNION ALL SELECT 'Location', count(*) FROM zones "
            "UNION ALL SELECT 'Order', count(*) FROM o_orders)"),
        "zone_routes": _sql(
            "SELECT src AS from_zone, dst AS to_zone, km AS distance_km, round(km/30*60,1) AS time_min FROM network",
            NETWORK),
        "copurchase_top5": graph(
            "SELECT a.name AS product_1, b.name AS product_2, count(DISTINCT x.order_id) AS orders_together "
            "FROM contains x JOIN contains y ON x.order_id=y.order_id AND x.prod_id<y.prod_id "
            "JOIN nodes_product a ON a.prod_id=x.prod_id JOIN nodes_product b ON b.prod_id=y.prod_id "
            "GROUP BY 1,2 ORDER BY 3 DESC,1,2 LIMIT 5"),
        "recommendation_degrees": _sql("SELECT * FROM degrees", CONTAINS, MERGED),
        "recommendations_top5": _sql(
            "SELECT src AS from_user, dst AS to_user, shared, place FROM (SELECT *, "
            "row_number() OVER (PARTITION BY src ORDER BY shared DESC, dst)::INT AS place FROM merged WHERE shared>=2) "
            "WHERE place<=5", CONTAINS, MERGED),
        "influencers_degree": _sql(
            "SELECT u.name AS user_name, u.zone, sum(recommends)::BIGINT AS recommended_users "
            "FROM degrees JOIN users u ON u.id=user_id GROUP BY 1,2 ORDER BY 3 DESC,1,2 LIMIT 10", CONTAINS, MERGED),
        "influencers_pagerank": _sql(
            "SELECT name AS user_name, zone, round(coalesce(score,0.15::DOUBLE),4) AS pagerank_score FROM users "
            "LEFT JOIN (SELECT * FROM pagerank WHERE k=20) USING (id) ORDER BY 3 DESC,1,2 LIMIT 10", CONTAINS, MERGED, PAGERANK),
        "shortest_hops": _sql(
            "SELECT array_to_string(p.route,'>') AS route, "
            "array_to_string([printf('%.2f',x) FOR x IN p.legs],'>') AS legs_km, round(list_sum(p.legs),2) AS total_km "
            "FROM levels WHERE k=24 AND node='NATION_7'", NETWORK, HOPS),
        "shortest_weighted": _sql(
            "SELECT array_to_string(p.route,'>') AS route, "
            "array_to_string([printf('%.2f',x) FOR x IN p.costs],'>') AS costs, round(p.km,2) AS total_km "
            "FROM best WHERE src='NATION_1' AND dst='NATION_13'", NETWORK),
        "far_hops": _sql(
            "SELECT array_to_string(p.route,'>') AS route, "
            "array_to_string([printf('%.2f',x) FOR x IN p.legs],'>') AS legs_km, round(list_sum(p.legs),2) AS total_km "
            "FROM levels WHERE k=24 AND node='NATION_9'", SPARSE, HOPS.replace("NATION_1", "NATION_7")),
        "far_weighted": _sql(
            "SELECT array_to_string(p.route,'>') AS route, "
            "array_to_string([printf('%.2f',x) FOR x IN p.costs],'>') AS costs, round(p.km,2) AS total_km "
            "FROM best WHERE src='NATION_7' AND dst='NATION_9'", SPARSE),
        "top3_per_category": graph(
            "SELECT * FROM (SELECT category, product, units, orders, "
            "row_number() OVER (PARTITION BY category ORDER BY units DESC, product)::INT AS place FROM "
            "(SELECT category, name AS product, sum(quantity)::BIGINT AS units, count(DISTINCT order_id) AS orders "
            "FROM contains JOIN nodes_product USING (prod_id) GROUP BY 1,2)) WHERE place<=3"),
        "courier_top_zone": graph(
            "SELECT courier_name, vehicle, total_deliveries, top_zone FROM ("
            "SELECT courier_name, vehicle, sum(n) OVER w::BIGINT AS total_deliveries, zone AS top_zone, "
            "row_number() OVER (PARTITION BY courier_name, vehicle ORDER BY n DESC, zone) AS rn FROM "
            "(SELECT c.name AS courier_name, c.vehicle, t.zone, count(*) AS n FROM deliveries d "
            "JOIN delivered_to t USING (order_id) JOIN couriers c ON c.id=d.courier_id GROUP BY 1,2,3) "
            "WINDOW w AS (PARTITION BY courier_name, vehicle)) WHERE rn=1").replace(
                "sum(n) OVER w::BIGINT", "(sum(n) OVER w)::BIGINT"),
    }
    return out


def routing_oracles() -> dict[str, str]:
    routes = lambda body: _sql(body, NETWORK, DISPATCH)
    return {
        "routing_couriers": _sql("SELECT * FROM fleet", DISPATCH.split("turns AS")[0].rstrip().rstrip(",")),
        "routing_pending": routes("SELECT * FROM pending"),
        "zone_distance": _sql("SELECT src AS from_zone, dst AS to_zone, round(p.km*100)/100 AS distance_km FROM best", NETWORK),
        "route_assignment": routes("SELECT * FROM routes"),
        "route_by_place": _sql("SELECT p.period, r.* FROM routes r JOIN pending p USING (order_id)", NETWORK, PLACE),
        "route_summary": routes(
            "SELECT batch, courier_id, count(*) AS orders, round(sum(distance_km),2) AS total_km, "
            "(sum(count(*)) OVER (PARTITION BY batch))::BIGINT AS batch_orders FROM routes GROUP BY batch, courier_id"),
    }


def quality_oracles() -> dict[str, str]:
    mart = lambda body: _sql(body, STAR, CUBES, MARTS)

    def check(name: str, value: str, threshold: int, passed: str, message: str, source: str) -> str:
        return (f"SELECT '{name}' AS check_name, {value}::BIGINT AS value, {threshold}::BIGINT AS threshold, "
                f"{value} {passed} {threshold} AS passed, '{message}' AS message FROM {source}")

    def relation(name: str, child: str, key: str, parent: str, parent_key: str) -> str:
        return (f"SELECT '{name}' AS relation, count(*) AS rows, count(*) FILTER ({key} IS NULL) AS null_keys, "
                f"count(*) FILTER ({key} IS NOT NULL AND {key} NOT IN (SELECT {parent_key} FROM {parent})) AS orphans "
                f"FROM {child}")

    buyers = "(SELECT id FROM users WHERE role='customer')"
    hashed = (
        "SELECT md5(length(id::VARCHAR)||':'||id||length(name)||':'||name"
        "||length(cents)||':'||cents||length(category_id::VARCHAR)||':'||category_id"
        "||length(available::VARCHAR)||':'||available::VARCHAR) AS h "
        "FROM (SELECT *, (round(price*100)::BIGINT)::VARCHAR AS cents FROM products)"
    )
    return {
        "dq_row_counts": mart(" UNION ALL ".join(
            check(name, "count(*)", 1, ">=", "no rows", name)
            for name in ("mart_trends", "mart_peak_hours", "mart_monthly_growth"))),
        "dq_min_orders": mart(check("mart_executive_summary", "total_orders", 1000, ">=", "fewer than 1000 orders",
                                    "mart_executive_summary")),
        "dq_null_revenue": mart(check("no_nulls_trends", "(count(*) FILTER (revenue IS NULL))", 1, "<", "null revenue",
                                      "mart_trends")),
        "dq_referential": _sql(" UNION ALL ".join([
            relation("orders.customer", "o_orders", "user_id", buyers, "id"),
            relation("orders.restaurant", "o_orders", "restaurant_id", "restaurants", "id"),
            relation("order_items.order", "items", "order_id", "o_orders", "id"),
            relation("order_items.product", "items", "product_id", "products", "id"),
            relation("deliveries.order", "deliveries", "order_id", "o_orders", "id"),
            relation("deliveries.courier", "deliveries", "courier_id", "couriers", "id"),
            relation("deliveries.zone", "deliveries", "dest_zone", "zones", "zone"),
            relation("products.category", "products", "category_id", "categories", "id"),
        ])),
        "catalog_fingerprint": _sql(
            "SELECT count(*) AS products, md5(concat_ws('|', count(*), sum(('0x'||substr(h,1,15))::BIGINT)::HUGEINT, "
            f"sum(('0x'||substr(h,17,15))::BIGINT)::HUGEINT)) AS digest FROM ({hashed})"),
        "catalog_range_digests": _sql(
            "SELECT id>>6 AS id_range, count(*) AS documents, concat_ws('|', sum(('0x'||substr(h,1,15))::BIGINT)::HUGEINT, "
            "sum(('0x'||substr(h,17,15))::BIGINT)::HUGEINT) AS digest FROM (SELECT prod_id AS id, "
            "md5(length(prod_id::VARCHAR)||':'||prod_id||length(name)||':'||name||length(cents)||':'||cents"
            "||length(available::VARCHAR)||':'||available::VARCHAR||length(category)||':'||category) AS h "
            "FROM (SELECT *, (round(price*100)::BIGINT)::VARCHAR AS cents FROM nodes_product)) GROUP BY 1", CONTAINS),
        "search_documents": _sql("SELECT prod_id AS id, name, price, available, category FROM nodes_product", CONTAINS),
        "orders_per_status": _sql("SELECT status, count(*) AS orders FROM o_orders GROUP BY 1"),
        "orders_per_month": _sql("SELECT date_trunc('month', order_ts)::DATE AS month, count(*) AS orders "
                                 "FROM o_orders GROUP BY 1"),
    }


def all_oracles() -> dict[str, str]:
    return {**warehouse_oracles(), **graph_oracles(), **routing_oracles(), **quality_oracles()}
