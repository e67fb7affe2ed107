"""Independent ANSI SQL (DuckDB dialect) for every checked query.

Written from the semantics, not from the Spark code: the M:N KPIs are
computed here with the literal fan-out joins of the reference, the dedup
with ROW_NUMBER, and so on.  Each string is a complete query over the
driver's views (region ... conversations).

DuckDB differences handled here (SURVEY 5): ``regexp_replace`` needs 'g';
``x/0`` gives inf, so divisors go through NULLIF; DATE + integer is a date.
"""

from __future__ import annotations

# --------------------------------------------------------------- base views
# Same mapping as tidewater.sources.views (FIXTURES.md section 3).
VIEWS = {
    "policies": """
  SELECT o.o_orderkey AS PolicyNumber, o.o_custkey AS CustomerID,
         o.o_orderpriority AS PolicyType, o.o_orderstatus AS PaymentFrequency,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS AnnualPremium_INR,
         CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) * 20 AS DECIMAL(18,2)) AS CoverageAmount_INR,
         CAST(o.o_orderdate AS DATE) AS PolicyStartDate,
         CAST(o.o_orderdate AS DATE) + 365 AS PolicyEndDate,
         s.s_suppkey AS AgentID, s.s_name AS AgentName
  FROM orders o
  LEFT JOIN supplier s ON s.s_suppkey = o.o_orderkey % (SELECT count(*) FROM supplier)""",
    "claims": """
  SELECT 10 * l.l_orderkey + l.l_linenumber AS ClaimID, l.l_orderkey AS PolicyNumber,
         o.o_custkey AS CustomerID, CAST(l.l_shipdate AS DATE) AS ClaimDate,
         CAST(l.l_shipdate AS DATE) + 30 AS SettlementDate,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS ClaimAmount_INR,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))
           AS SettledAmount_INR
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE l.l_returnflag = 'R'""",
    "payments": """
  SELECT 10 * l.l_orderkey + l.l_linenumber AS TransactionID, o.o_custkey AS CustomerID,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS Amount_INR,
         CAST(o.o_orderdate AS DATE) AS ScheduledDate,
         CASE WHEN l.l_linenumber <> 7 THEN CAST(l.l_shipdate AS DATE) END AS PaidDate
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE l.l_linestatus = 'F'""",
    "customer_geo": """
  SELECT c.c_custkey, c.c_name, c.c_mktsegment, n.n_name, r.r_name
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "dim_customer": """
  SELECT 2 * c_custkey + 1 AS CustomerKey, c_custkey AS CustomerID, c_mktsegment AS City,
         n_name AS State, r_name AS Country, true AS IsCurrent FROM customer_geo
  UNION ALL
  SELECT 2 * c_custkey, c_custkey, 'OLD', n_name, r_name, false
  FROM customer_geo WHERE c_custkey % 5 = 0""",
    "dim_vehicle": """
  SELECT o.o_orderkey + 1000000 AS VehicleKey, o.o_orderkey AS PolicyNumber,
         p.p_brand AS VehicleMake, true AS IsCurrent
  FROM orders o LEFT JOIN part p ON p.p_partkey = o.o_orderkey % (SELECT count(*) FROM part)
  WHERE o.o_orderkey % 4 <> 0""",
    # the facts, worked out from the rule "one row per source row whose
    # customer has a current version, with the current vehicle if any"
    "current_customer": """
  SELECT CustomerID AS cid, max(CustomerKey) AS ckey FROM dim_customer WHERE IsCurrent GROUP BY 1""",
    "current_vehicle": """
  SELECT PolicyNumber AS pno, max(VehicleKey) AS vkey FROM dim_vehicle WHERE IsCurrent GROUP BY 1""",
    "fact_policy": """
  SELECT (SELECT ckey FROM current_customer WHERE cid = p.CustomerID) AS CustomerKey,
         (SELECT vkey FROM current_vehicle WHERE pno = p.PolicyNumber) AS VehicleKey,
         p.PolicyNumber, p.PolicyType, p.AnnualPremium_INR, p.CoverageAmount_INR, p.PolicyStartDate, p.PolicyEndDate
  FROM policies p WHERE EXISTS (SELECT 1 FROM current_customer WHERE cid = p.CustomerID)""",
    "fact_claims": """
  SELECT x.ClaimID, (SELECT ckey FROM current_customer WHERE cid = x.CustomerID) AS CustomerKey,
         (SELECT vkey FROM current_vehicle WHERE pno = x.PolicyNumber) AS VehicleKey,
         x.ClaimDate, x.ClaimAmount_INR, x.SettledAmount_INR
  FROM claims x WHERE EXISTS (SELECT 1 FROM current_customer WHERE cid = x.CustomerID)""",
    "fact_payments": """
  SELECT x.TransactionID, (SELECT ckey FROM current_customer WHERE cid = x.CustomerID) AS CustomerKey,
         x.Amount_INR, x.PaidDate
  FROM payments x WHERE EXISTS (SELECT 1 FROM current_customer WHERE cid = x.CustomerID)""",
    "call_notes": """
  SELECT PolicyNumber, 'Spoke to ' || c_name || ' ' || f || ' on policy ' || PolicyNumber || '. ' || upper(f) || '''s car, not '
         || f || 'x nor x' || f || '; cc ' || lower(c_name) || ',' || o || '/' || f || ' é' || o AS note
  FROM (SELECT PolicyNumber, c_name, 'Family' || (CustomerID % 100) AS f, 'Family' || (PolicyNumber % 130) AS o
        FROM policies JOIN customer ON c_custkey = CustomerID)""",
    "bronze_policies": """
  SELECT PolicyNumber, CustomerID, PolicyType, PaymentFrequency, AgentID, AgentName,
         CAST(CoverageAmount_INR AS VARCHAR) AS CoverageAmount_INR,
         CAST(AnnualPremium_INR AS VARCHAR) AS AnnualPremium_INR,
         CAST(PolicyStartDate AS VARCHAR) AS PolicyStartDate,
         CAST(PolicyEndDate AS VARCHAR) AS PolicyEndDate,
         'India' AS _src_country, '2024-01-01' AS SnapshotDate,
         'policies_master_2024-01-01.csv' AS FileName
  FROM policies
  UNION ALL
  SELECT PolicyNumber, CustomerID, PolicyType, PaymentFrequency, AgentID, AgentName,
         CAST(CoverageAmount_INR AS VARCHAR),
         CAST(CAST(AnnualPremium_INR * 2 AS DECIMAL(18,2)) AS VARCHAR),
         CAST(PolicyStartDate AS VARCHAR), CAST(PolicyEndDate AS VARCHAR),
         'India', '2024-02-01', 'policies_master_2024-02-01.csv'
  FROM policies WHERE PolicyNumber % 3 = 0
  UNION ALL
  SELECT PolicyNumber, CustomerID, NULL, PaymentFrequency, AgentID, AgentName,
         CAST(CoverageAmount_INR AS VARCHAR), NULL,
         CAST(PolicyStartDate AS VARCHAR), CAST(PolicyEndDate AS VARCHAR),
         'India', '2024-03-01', 'policies_master_2024-03-01.csv'
  FROM policies WHERE PolicyNumber % 7 = 0""",
    "customer_base": """
  SELECT c_custkey AS CustomerID, c_name AS FirstName,
         'Family' || CAST(c_custkey % 100 AS VARCHAR) AS LastName,
         'User.' || CAST(c_custkey AS VARCHAR) || '@Example.COM' AS Email,
         '+91-(020) ' || CAST(c_custkey AS VARCHAR) AS Phone,
         CASE WHEN c_custkey % 97 = 0 THEN '31/12/2020'
              ELSE CAST(DATE '1950-01-01' + CAST((c_custkey * 37) % 18000 AS INTEGER) AS VARCHAR)
         END AS DOB,
         CASE WHEN c_custkey % 89 = 0 THEN 'n/a' ELSE CAST(c_custkey % 60 + 18 AS VARCHAR) END AS Age,
         c_mktsegment AS City, n_name AS State, r_name AS Country
  FROM customer_geo""",
    "bronze_customers": """
  SELECT *, 'India' AS _src_country, '2024-01-01' AS SnapshotDate,
         'insurance_customer_2024-01-01.csv' AS FileName FROM customer_base
  UNION ALL
  SELECT CustomerID, FirstName, LastName, Email, Phone, DOB, Age,
         CASE WHEN CustomerID % 5 = 0 THEN 'MOVED' ELSE City END, State, Country,
         'India', '2024-02-01', 'insurance_customer_2024-02-01.csv' FROM customer_base
  UNION ALL
  SELECT CustomerID, FirstName, LastName, Email, Phone, DOB, Age,
         CASE WHEN CustomerID % 5 = 0 THEN 'MOVED' ELSE City END, State, Country,
         'India', '2024-03-01', 'insurance_customer_2024-03-01.csv'
  FROM customer_base WHERE CustomerID % 2 = 0""",
    "silver_policies": """
  SELECT PolicyNumber, CustomerID, COALESCE(PolicyType, 'UNKNOWN') AS PolicyType,
         PaymentFrequency, AgentID, AgentName,
         COALESCE(TRY_CAST(CoverageAmount_INR AS DECIMAL(18,2)), 0) AS CoverageAmount_INR,
         COALESCE(TRY_CAST(AnnualPremium_INR AS DECIMAL(18,2)), 0) AS AnnualPremium_INR,
         TRY_CAST(PolicyStartDate AS DATE) AS PolicyStartDate,
         TRY_CAST(PolicyEndDate AS DATE) AS PolicyEndDate,
         _src_country, TRY_CAST(SnapshotDate AS DATE) AS SnapshotDate, FileName
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY PolicyNumber
                   ORDER BY TRY_CAST(SnapshotDate AS DATE) DESC NULLS LAST,
                            FileName DESC NULLS LAST) AS rn
        FROM bronze_policies WHERE PolicyNumber IS NOT NULL) WHERE rn = 1""",
    # SCD2 over the customer snapshots: a new version whenever a tracked
    # attribute differs from the key's previous snapshot (NULL-safe).
    "dim_customer_scd2": """
  SELECT CAST('0x' || substr(md5(CustomerID || '|' || EffectiveFrom), 1, 15) AS BIGINT) AS CustomerKey,
         CustomerID, City, State, Country, EffectiveFrom,
         LEAD(EffectiveFrom) OVER (PARTITION BY CustomerID ORDER BY EffectiveFrom) AS EffectiveTo,
         LEAD(EffectiveFrom) OVER (PARTITION BY CustomerID ORDER BY EffectiveFrom) IS NULL AS IsCurrent
  FROM (
    SELECT *, (LAG(SnapshotDate) OVER w IS NULL
               OR City IS DISTINCT FROM LAG(City) OVER w
               OR State IS DISTINCT FROM LAG(State) OVER w
               OR Country IS DISTINCT FROM LAG(Country) OVER w) AS changed,
           SnapshotDate AS EffectiveFrom
    FROM (SELECT CustomerID, City, State, Country, CAST(SnapshotDate AS DATE) AS SnapshotDate
          FROM bronze_customers WHERE CustomerID IS NOT NULL)
    WINDOW w AS (PARTITION BY CustomerID ORDER BY SnapshotDate)
  ) WHERE changed""",
    "bronze_vehicles": """
  SELECT PolicyNumber, VehicleMake, DATE '2024-01-01' AS SnapshotDate FROM dim_vehicle
  UNION ALL SELECT PolicyNumber, 'REPLACED', DATE '2024-02-01' FROM dim_vehicle WHERE PolicyNumber % 6 = 0
  UNION ALL SELECT PolicyNumber, VehicleMake, DATE '2024-03-01' FROM dim_vehicle WHERE PolicyNumber % 2 = 1""",
    "dim_vehicle_scd2": """
  SELECT CAST('0x' || substr(md5(PolicyNumber || '|' || EffectiveFrom), 1, 15) AS BIGINT) AS VehicleKey,
         PolicyNumber, VehicleMake, EffectiveFrom, EffectiveTo, EffectiveTo IS NULL AS IsCurrent
  FROM (SELECT PolicyNumber, VehicleMake, SnapshotDate AS EffectiveFrom,
               LEAD(SnapshotDate) OVER (PARTITION BY PolicyNumber ORDER BY SnapshotDate) AS EffectiveTo
        FROM (SELECT *, LAG(VehicleMake) OVER w AS before, LAG(SnapshotDate) OVER w IS NULL AS first FROM bronze_vehicles
              WINDOW w AS (PARTITION BY PolicyNumber ORDER BY SnapshotDate))
        WHERE first OR before IS DISTINCT FROM VehicleMake)""",
    # ids of the layer run: claims and payments get one of their own
    "keyed_claims": """
  SELECT * REPLACE (CAST('0x' || substr(md5(concat_ws('|', ClaimID, ClaimDate, ClaimAmount_INR)), 1, 15) AS BIGINT) AS ClaimID)
  FROM claims""",
    "keyed_payments": """
  SELECT * REPLACE (CAST('0x' || substr(md5(concat_ws('|', TransactionID, PaidDate, Amount_INR)), 1, 15) AS BIGINT) AS TransactionID)
  FROM payments""",
    # of the overlapping deliveries the latest counts: as first delivered
    # where the 3rd has the row, else doubled where the 2nd has it
    "layer_payments": """
  SELECT * REPLACE (Amount_INR * CASE WHEN TransactionID % 7 <> 0 AND TransactionID % 3 = 0 THEN 2 ELSE 1 END AS Amount_INR)
  FROM keyed_payments""",
    "layer_fact_policy": """
  SELECT dc.CustomerKey, sp.PolicyNumber, sp.PolicyType, sp.AnnualPremium_INR
  FROM silver_policies sp, dim_customer_scd2 dc WHERE dc.CustomerID = sp.CustomerID AND dc.EffectiveTo IS NULL""",
    "layer_fact_claims": """
  SELECT k.ClaimID, dc.CustomerKey,
         k.SettledAmount_INR * CASE WHEN ClaimID % 7 <> 0 AND ClaimID % 3 = 0 THEN 2 ELSE 1 END AS SettledAmount_INR
  FROM keyed_claims k, dim_customer_scd2 dc WHERE dc.CustomerID = k.CustomerID AND dc.EffectiveTo IS NULL""",
}

_VIEW_ORDER = list(VIEWS)


def with_views(body: str) -> str:
    """Prefix a query with every base view as a CTE (DuckDB inlines and
    skips the ones the body does not use)."""
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]}\n)" for name in _VIEW_ORDER)
    text = body.strip()
    if text[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{text[5:]}"
    return f"WITH {ctes}\n{text}"
