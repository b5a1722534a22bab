"""DuckDB statements of the marts and the RFM tables, from the definitions in
SURVEY §2.9: one small aggregate per measure, joined by key.

Joins that multiply lines (repeated product or store ids) are not carried out:
a line weighs as many rows as they would make of it. Picks are the first of an
ordered aggregate, tiles come from positions. Both semantics share the
builders; what differs is passed in."""

from __future__ import annotations

Ctes = dict[str, tuple[str, tuple[str, ...]]]

DAY = "CAST(bill_date_timestamp AS DATE)"


def _per_key(key: str, lines: str, value: str, name: str) -> str:
    """Distinct non-NULL values of each key."""
    return f"SELECT {key}, count(v) AS {name} FROM (SELECT DISTINCT {key}, {value} AS v FROM {lines}) GROUP BY {key}"


def _joined(first: str, others: dict[str, str], key: str) -> str:
    """Measures side by side; the key is never NULL or is compared NULL-safely."""
    joins = "".join(f"\nJOIN ({sql}) {name} ON {name}.{key} IS NOT DISTINCT FROM {first}.{key}" for name, sql in others.items())
    return joins


def customer(p: str, lines: str, products: str, stores: str, customers: str, key: str, monetary: str, profit: str,
             used: str, inactive_as_of: str) -> Ctes:
    """customer_behaviour, the payment summary and the customer mart, under prefix p."""
    w = f"{p}_weighted"
    distinct = {
        "items": _per_key(key, w, "product_id", "distinct_items_purchased"),
        "categories": f"SELECT {key}, count(DISTINCT category) AS distinct_categories_purchased FROM (SELECT DISTINCT {key}, product_id FROM {w}) "
                      f"LEFT JOIN {products} USING (product_id) GROUP BY {key}",
        "channels": _per_key(key, w, "channel", "channels_used"),
        "shops": _per_key(key, w, "delivered_store_id", "distinct_stores_purchased"),
        "cities": f"SELECT {key}, count(DISTINCT seller_city) AS distinct_cities_purchased FROM (SELECT DISTINCT {key}, delivered_store_id AS store_id FROM {w}) "
                  f"LEFT JOIN {stores} USING (store_id) GROUP BY {key}",
        "days": f"SELECT {key}, count(d) AS frequency, min(d) AS first_transaction_date, max(d) AS last_transaction_date "
                f"FROM (SELECT DISTINCT {key}, {DAY} AS d FROM {w}) GROUP BY {key}",
    }
    id_column = "" if key == "custid" else "TRY_CAST(sums.customer_id AS BIGINT) AS custid, "
    return {
        w: (f"""
SELECT l.*, coalesce(pn.n, 1) * coalesce(sn.n, 1) AS w FROM {lines} l
LEFT JOIN (SELECT product_id, count(*) AS n FROM {products} GROUP BY product_id) pn USING (product_id)
LEFT JOIN (SELECT store_id AS delivered_store_id, count(*) AS n FROM {stores} GROUP BY store_id) sn USING (delivered_store_id)""",
            (lines, products, stores)),
        f"{p}_behaviour": (f"""
SELECT sums.*, {id_column}days.* EXCLUDE ({key}), CAST(last_transaction_date - first_transaction_date AS INTEGER) AS tenure,
  distinct_items_purchased, distinct_categories_purchased, channels_used, distinct_stores_purchased, distinct_cities_purchased
FROM (SELECT {key}, sum(w * {monetary}) AS monetary, sum(w * {profit}) AS profit, sum(w * discount) AS discount,
        CAST(sum(w * quantity) AS BIGINT) AS total_quantity,
        CAST(coalesce(sum(w) FILTER (WHERE discount > 0), 0) AS BIGINT) AS transactions_with_discount,
        CAST(coalesce(sum(w) FILTER (WHERE mrp < cost_per_unit), 0) AS BIGINT) AS transactions_with_loss
      FROM {w} GROUP BY {key}) sums{_joined("sums", distinct, key)}""", (w, products, stores)),
        f"{p}_used": (f"""
SELECT {key}, payment_type, CAST({used} AS BIGINT) AS payment_count
FROM (SELECT {key}, order_id, count(*) AS n_lines FROM {lines} GROUP BY {key}, order_id)
LEFT JOIN (SELECT order_id, payment_type, count(payment_type) AS n_pays FROM clean_payments GROUP BY order_id, payment_type)
USING (order_id) GROUP BY {key}, payment_type""", (lines, "clean_payments")),
        f"{p}_payments": (f"""
SELECT a.{key}, TRY_CAST(a.{key} AS BIGINT) AS custid, a.payment_type, a.payment_count, CAST(count(b.{key}) + 1 AS INTEGER) AS rn
FROM {p}_used a LEFT JOIN {p}_used b ON a.{key} = b.{key} AND (b.payment_count > a.payment_count
  OR b.payment_count = a.payment_count AND coalesce(b.payment_type < a.payment_type, b.payment_type IS NULL AND a.payment_type IS NOT NULL))
GROUP BY a.{key}, a.payment_type, a.payment_count""".replace("SELECT a.custid, TRY_CAST(a.custid AS BIGINT) AS custid", "SELECT a.custid"),
                          (f"{p}_used",)),
        f"{p}_mart": (f"""
WITH people AS (
  SELECT b.* {'EXCLUDE (customer_id)' if key == 'customer_id' else ''}, c.* EXCLUDE (custid), count(*) AS copies
  FROM {p}_behaviour b LEFT JOIN {customers} c ON b.custid = c.custid GROUP BY ALL),
paid AS (
  SELECT custid, count(DISTINCT payment_type) AS kinds, max(payment_type) FILTER (WHERE rn = 1) AS preferred,
    map_from_entries(list((payment_type, total)) FILTER (WHERE payment_type IS NOT NULL)) AS totals
  FROM (SELECT custid, payment_type, min(rn) AS rn, sum(payment_count) AS total FROM {p}_payments GROUP BY custid, payment_type)
  GROUP BY custid)
SELECT people.*, CAST(DATE '{inactive_as_of}' - last_transaction_date AS INTEGER) AS inactive_days,
  coalesce(kinds, 0) AS distinct_payment_types_used, preferred AS preferred_payment_method,
  CAST(copies * coalesce(totals['Voucher'], 0) AS BIGINT) AS transactions_paid_with_voucher,
  CAST(copies * coalesce(totals['Credit Card'], 0) AS BIGINT) AS transactions_paid_with_credit_card,
  CAST(copies * coalesce(totals['Debit Card'], 0) AS BIGINT) AS transactions_paid_with_debit_card,
  CAST(copies * coalesce(totals['UPI'], 0) AS BIGINT) AS transactions_paid_with_upi
FROM people LEFT JOIN paid USING (custid)""", (f"{p}_behaviour", f"{p}_payments", customers)),
    }


def picks() -> Ctes:
    """One row per key of each dimension, the first under the stated order."""
    def first(columns: list[str], by: str) -> str:
        return ", ".join(f"first({c} ORDER BY {by}) AS {c}" for c in columns)

    place = ["seller_city", "seller_state", "region"]
    return {
        "om_pay": ("SELECT order_id, " + first(["payment_type", "payment_value"], "payment_value DESC NULLS LAST, payment_type NULLS FIRST")
                   + " FROM clean_payments GROUP BY order_id", ("clean_payments",)),
        "om_review": ("SELECT order_id, max(score) AS score FROM clean_reviews GROUP BY order_id", ("clean_reviews",)),
        "om_product": ("SELECT product_id, " + first(["category"], "category NULLS FIRST") + " FROM clean_products GROUP BY product_id", ("clean_products",)),
        "om_store": ("SELECT store_id, " + first(place, ", ".join(f"{c} NULLS FIRST" for c in place)) + " FROM clean_stores GROUP BY store_id", ("clean_stores",)),
        "om_customer": ("SELECT custid, min(gender) AS gender, min(customer_state) AS customer_state FROM clean_customers GROUP BY custid", ("clean_customers",)),
    }


def order(name: str, lines: str, numeric: str, discount: str, score: str, state: str) -> Ctes:
    """The order mart: each line with what its five keys look up."""
    return {name: (f"""
WITH keyed AS (
  SELECT *, CASE WHEN regexp_full_match(customer_id, {numeric}) THEN TRY_CAST(customer_id AS BIGINT) END AS custid,
    delivered_store_id AS store_id, total_amount - total_cost AS margin FROM {lines})
SELECT order_id, custid, product_id, store_id, bill_date_timestamp AS order_date, category AS product_category, quantity, total_amount,
  {discount} AS discount, payment_type, payment_value AS payment_amount, {score} AS satisfaction_score, seller_city AS store_city,
  seller_state, region, total_cost, margin AS profit, channel, CAST(cost_per_unit AS DECIMAL(18,2)) AS cost_per_unit, mrp, gender,
  {state} AS store_state
FROM keyed NATURAL LEFT JOIN om_product NATURAL LEFT JOIN om_store LEFT JOIN om_customer USING (custid)
LEFT JOIN om_pay USING (order_id) LEFT JOIN om_review USING (order_id)""", (lines, *picks()))}


def store(p: str, lines: str, products: str, stores: str, profit: str) -> Ctes:
    """The three top picks of each store and the store mart, under prefix p."""
    w, key = f"{p}_weighted", "store_id"
    measures = {
        "people": _per_key(key, w, "customer_id", "distinct_customers_visited"),
        "goods": _per_key(key, w, "product_id", "distinct_products_sold"),
        "kinds": f"SELECT {key}, count(DISTINCT category) AS distinct_categories_sold FROM (SELECT DISTINCT {key}, product_id FROM {w}) "
                 f"LEFT JOIN {products} USING (product_id) GROUP BY {key}",
        "days": f"SELECT {key}, count(d) AS active_days, min(d) AS min_transaction_date, max(d) AS max_transaction_date "
                f"FROM (SELECT DISTINCT {key}, {DAY} AS d FROM {w}) GROUP BY {key}",
        "mood": f"SELECT {key}, round(sum(w * score) / sum(w) FILTER (WHERE score IS NOT NULL), 9) AS average_customer_satisfaction "
                f"FROM {w} LEFT JOIN clean_reviews USING (order_id) GROUP BY {key}",
    }
    return {
        w: (f"""
SELECT l.*, delivered_store_id AS store_id, {profit} AS gain, coalesce(n, 1) AS w FROM {lines} l
LEFT JOIN (SELECT product_id, count(*) AS n FROM {products} GROUP BY product_id) USING (product_id)""", (lines, products)),
        f"{p}_top_product": (f"""
SELECT store_id, first(product_id ORDER BY q DESC NULLS LAST, product_id NULLS FIRST) AS product_id, max(q) AS total_quantity
FROM (SELECT delivered_store_id AS store_id, product_id, CAST(sum(quantity) AS BIGINT) AS q FROM {lines} GROUP BY ALL) GROUP BY store_id""", (lines,)),
        f"{p}_top_customer": (f"""
SELECT store_id, first(customer_id ORDER BY n DESC, customer_id NULLS FIRST) AS customer_id, max(n) AS total_orders
FROM (SELECT delivered_store_id AS store_id, customer_id, count(order_id) AS n FROM {lines} GROUP BY ALL) GROUP BY store_id""", (lines,)),
        f"{p}_top_payment": (f"""
SELECT store_id, first(payment_type ORDER BY n DESC, payment_type NULLS FIRST) AS payment_type, max(n) AS payment_count
FROM (SELECT store_id, payment_type, CAST(sum(n_lines * n_pays) AS BIGINT) AS n
      FROM (SELECT delivered_store_id AS store_id, order_id, count(*) AS n_lines FROM {lines} GROUP BY ALL)
      JOIN (SELECT order_id, payment_type, count(*) AS n_pays FROM clean_payments GROUP BY ALL) USING (order_id)
      GROUP BY ALL) GROUP BY store_id""", (lines, "clean_payments")),
        f"{p}_mart": (f"""
WITH sums AS (
  SELECT store_id, CAST(coalesce(sum(w) FILTER (WHERE order_id IS NOT NULL), 0) AS BIGINT) AS total_transactions,
    CAST(sum(w * quantity) AS BIGINT) AS total_quantity_sold, sum(w * total_amount) AS total_sales, sum(w * gain) AS total_profit,
    CAST(sum(w * discount) AS DOUBLE) / CAST(sum(w) FILTER (WHERE discount IS NOT NULL) AS DOUBLE) AS average_discount,
    CAST(coalesce(sum(w) FILTER (WHERE discount > 0), 0) AS BIGINT) AS transactions_with_discount,
    CAST(coalesce(sum(w) FILTER (WHERE gain < 0), 0) AS BIGINT) AS transactions_with_loss
  FROM {w} GROUP BY store_id),
facts AS (SELECT sums.*, {', '.join(f'{name}.* EXCLUDE (store_id)' for name in measures)} FROM sums{_joined("sums", measures, key)})
SELECT facts.*, place.* EXCLUDE (store_id), tp.product_id AS highest_selling_product, tc.customer_id AS most_frequent_customer,
  py.payment_type AS most_common_payment_type
FROM facts LEFT JOIN {stores} place USING (store_id) LEFT JOIN {p}_top_product tp USING (store_id)
LEFT JOIN {p}_top_customer tc USING (store_id) LEFT JOIN {p}_top_payment py USING (store_id)""",
                      (w, products, stores, "clean_reviews", f"{p}_top_product", f"{p}_top_customer", f"{p}_top_payment")),
    }


def rfm(p: str, mart: str, as_of: str, best_first: bool) -> Ctes:
    """Recency, the scores from positions, and the segments from a table of bands."""
    def tile(by: str, name: str) -> str:
        pos = f"(row_number() OVER (ORDER BY {by}) - 1)"
        t = f"CASE WHEN {pos} < n % 4 * (n // 4 + 1) THEN {pos} // (n // 4 + 1) ELSE n % 4 + ({pos} - n % 4 * (n // 4 + 1)) // (n // 4) END"
        return f"CAST({t} + 1 AS INTEGER) AS {name}" if best_first else f"CAST(4 - ({t}) AS INTEGER) AS {name}"

    return {
        f"{p}_raw": (f"""
SELECT custid, CAST(DATE '{as_of}' - last_transaction_date AS INTEGER) AS recency, frequency, monetary
FROM {mart} GROUP BY custid, last_transaction_date, frequency, monetary""", (mart,)),
        f"{p}_scored": (f"""
SELECT custid, recency, frequency, monetary,
  {tile("recency NULLS FIRST, custid NULLS FIRST, frequency NULLS FIRST, monetary NULLS FIRST", "recency_score")},
  {tile("frequency DESC NULLS LAST, custid NULLS FIRST, recency NULLS FIRST, monetary NULLS FIRST", "frequency_score")},
  {tile("monetary DESC NULLS LAST, custid NULLS FIRST, recency NULLS FIRST, frequency NULLS FIRST", "monetary_score")}
FROM {p}_raw, (SELECT count(*) AS n FROM {p}_raw)""", (f"{p}_raw",)),
        f"{p}_segmented": (f"""
WITH band(low, high, label) AS (VALUES (3, 6, 'At Risk Customers'), (7, 9, 'Loyal Customers'), (10, 12, 'Best Customers')),
summed AS (SELECT *, recency_score + frequency_score + monetary_score AS total_score FROM {p}_scored)
SELECT summed.*, coalesce(label, 'Undefined') AS customer_segment FROM summed LEFT JOIN band ON total_score BETWEEN low AND high""", (f"{p}_scored",)),
    }
