"""Daily venue report tables.

The source writes these as correlated scalar subqueries per output row.  Each
is re-expressed here as pre-aggregation on the subquery's key followed by an
equi-join on that key, so every fact table is scanned once, partially
aggregated map-side, and shuffled only at aggregate granularity.

Money inputs are DECIMAL, so sums are exact and independent of partition order;
report measures are emitted as DOUBLE once the exact sums are complete.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import current_week, day_of_week, week_number
from ..functions.text import clock_text, full_name, hour_label
from ..operators.lookups import top1

# Income tender types left out of the end-of-day debits.
EXCLUDED_TENDERS = ("Player Card", "Employee Discount", "Discounts", "Gratuity", "Coupon",
                    "Member Discount", "Reschedule")


def _d(c) -> Column:
    return F.col(c).cast("double")


# ---------------------------------------------------------------------------
# R1 labour cost per store, date and hour, with that hour's sales
# ---------------------------------------------------------------------------
def labor_cost(labor_hourly: DataFrame, sales_summary: DataFrame) -> DataFrame:
    keys = ["StoreId", "WorkDate", "Hour"]
    labour = (labor_hourly.groupBy(*keys)
              .agg(F.round(F.sum("EffectiveHourlyLaborCost"), 2).alias("Labor_cost"),
                   F.round(F.sum("LaborHours"), 2).alias("Hours_Worked")))
    # Sales on the same key, pre-aggregated so the join is 1:1 and both sides
    # arrive hash-partitioned on the same three columns (no extra exchange).
    sales = (sales_summary
             .select(F.col("StoreId"), F.col("Business_Date").alias("WorkDate"), F.col("HourNo").alias("Hour"),
                     (F.col("AmountSold") - F.col("AmountReturned")).alias("net"))
             .groupBy(*keys).agg(F.sum("net").alias("net")))
    j = labour.join(sales, keys, "left")
    return j.select(
        F.col("StoreId").alias("Store_Id"),
        F.col("WorkDate").alias("Work_Date"),
        day_of_week("WorkDate").alias("Week_Day"),
        F.col("Hour"),
        _d("Labor_cost").alias("Labor_cost"),
        _d("Hours_Worked").alias("Hours_Worked"),
        F.coalesce(F.round("net", 2), F.lit(0)).cast("double").alias("Sales"),
        hour_label("Hour").alias("HourAMPM"),
    )


# ---------------------------------------------------------------------------
# R2 worked vs scheduled payroll
# ---------------------------------------------------------------------------
def hourly_payroll(labor: DataFrame, employees: DataFrame, schedule: DataFrame) -> DataFrame:
    keys = ["StoreId", "EmpId", "Department", "Business_Date"]
    # One aggregate gives both the DISTINCT key set and the four per-key sums.
    # A null key part never equals itself in the source's correlation, so its sums are null.
    key_ok = F.col("StoreId").isNotNull() & F.col("EmpId").isNotNull() \
        & F.col("Department").isNotNull() & F.col("Business_Date").isNotNull()
    lm = (labor.groupBy(*keys)
          .agg(F.sum("RegularHours").alias("rh"), F.sum("OvertimeHours").alias("oh"),
               F.sum("RegularPay").alias("rp"), F.sum("OvertimePay").alias("op")))
    lm = lm.select(*keys, *[F.when(key_ok, F.col(c)).alias(c) for c in ("rh", "oh", "rp", "op")])
    emp = employees.select(F.col("StoreId"), F.col("EmployeeId").alias("EmpId"),
                           F.col("EmployeeNumber").alias("em_number"),
                           F.col("LastName").alias("em_last"), F.col("FirstName").alias("em_first"))
    worked = lm.join(emp, ["StoreId", "EmpId"], "inner")

    sched = (schedule.join(emp, ["StoreId", "EmpId"], "inner")
             .select(*[F.col(c).alias("s_" + c) for c in schedule.columns],
                     F.col("em_number").alias("s_number"),
                     full_name("em_last", "em_first").alias("s_name"))
             .distinct())
    cond = ((F.col("EmpId") == F.col("s_EmpId")) & (F.col("Department") == F.col("s_Department"))
            & (F.col("Business_Date") == F.col("s_Business_Date")) & (F.col("StoreId") == F.col("s_StoreId")))
    j = worked.join(sched, cond, "full_outer")
    return j.select(
        F.coalesce("StoreId", "s_StoreId").alias("StoreID"),
        F.coalesce("Department", "s_Department").alias("Department"),
        F.coalesce("Business_Date", "s_Business_Date").alias("Business_Date"),
        F.coalesce("em_number", "s_number").alias("Employee_Number"),
        F.when(F.col("em_last").isNull(), F.col("s_name"))
         .otherwise(full_name("em_last", "em_first")).alias("Employee_Name"),
        F.coalesce(F.col("s_ScheduledHours"), F.lit(0)).cast("double").alias("Schedule_Hours"),
        _d("rh").alias("Regular_Hours"),
        _d("oh").alias("Overtime_Hours"),
        _d("rp").alias("Regular_Pay"),
        _d("op").alias("Overtime_Pay"),
        F.when(F.col("s_PayRate").isNull(), F.col("s_DefaultPayRate") * F.col("s_ScheduledHours"))
         .otherwise(F.col("s_PayRate") * F.col("s_ScheduledHours")).cast("double").alias("Schedule_Pay"),
    )


# ---------------------------------------------------------------------------
# R3 cashier over/short
# ---------------------------------------------------------------------------
def cashier_over_short(history: DataFrame, employees: DataFrame, labor: DataFrame) -> DataFrame:
    emp = employees.select(F.col("StoreId"), F.col("EmployeeId").alias("EmpId"),
                           F.col("LastName"), F.col("FirstName"))
    eh = history.join(emp, ["StoreId", "EmpId"], "inner")
    # TOP 1 (Department, Position, RevenueCenter) per store/employee/date: one row supplies all three.
    first = top1(labor, ["StoreId", "EmpId", "Business_Date"], ["Department", "Position", "RevenueCenter"], "t_")
    j = eh.join(first, ["StoreId", "EmpId", "Business_Date"], "left")
    return j.select(
        F.col("StoreId").alias("Store_Id"),
        full_name("LastName", "FirstName").alias("Employee_Name"),
        _d("TillOverShortAmount").alias("Till_Over_Short_Amount"),
        F.col("ManualRedemptionTickets").alias("Manual_Redemption_Tickets"),
        F.col("Business_Date"),
        F.coalesce(F.col("OverShortReason"), F.lit("Balanced")).alias("Reason"),
        F.col("MgrEmpNo"),
        F.coalesce(F.col("t_Department"), F.lit("Entire Site")).alias("Department"),
        F.coalesce(F.col("t_Position"), F.lit("Kiosk")).alias("Position"),
        F.coalesce(F.col("t_RevenueCenter"), F.lit("Entire Site")).alias("Revenue_Center"),
    )


# ---------------------------------------------------------------------------
# R4 hours-worked warning
# ---------------------------------------------------------------------------
def hours_worked(schedule: DataFrame, labor: DataFrame, employees: DataFrame,
                 as_of: _dt.date | str) -> DataFrame:
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    wk_lo, wk_hi = current_week(as_of)
    zero = F.lit(0).cast("decimal(1,0)")      # the union widens to the input's own type: hours keep their scale
    # Union the two inputs at row level and aggregate once: the sum of per-branch
    # group sums equals the sum over the union.
    sched = (schedule.filter(F.col("Business_Date").between(F.lit(wk_lo), F.lit(wk_hi)))
             .select("StoreId", "Business_Date", "EmpId",
                     F.col("ScheduledHours").alias("sched"),
                     zero.alias("total"), zero.alias("ot")))
    work = labor.select("StoreId", "Business_Date", "EmpId", zero.alias("sched"),
                        (F.col("RegularHours") + F.col("OvertimeHours")).alias("total"), F.col("OvertimeHours").alias("ot"))
    both = sched.unionByName(work)
    # A day's hours fit the input's own type; keeping it there leaves the later sums their scale.
    x = (both.groupBy("StoreId", "Business_Date", "EmpId")
         .agg(*[F.sum(c).cast(both.schema[c].dataType).alias(c) for c in ("sched", "total", "ot")]))
    emp = employees.select(F.col("StoreId"), F.col("EmployeeId").alias("EmpId"), "LastName", "FirstName")
    # Regroup with the names, as the source does (a duplicated employee row merges
    # only when names agree).  The join output is already partitioned on
    # (StoreId, EmpId), a subset of these keys, so this adds no exchange.
    g = (x.join(emp, ["StoreId", "EmpId"], "inner")
         .groupBy("StoreId", "Business_Date", "EmpId", "LastName", "FirstName")
         .agg(F.sum("sched").alias("sched"), F.sum("total").alias("total"), F.sum("ot").alias("ot")))
    past = F.col("Business_Date") < F.lit(as_of)
    t = g.select(
        F.col("StoreId").alias("Store_Id"),
        F.col("Business_Date").alias("Business_date"),
        F.when(past, F.col("total")).otherwise(F.col("sched")).alias("Total_Hours"),
        F.when(past, F.lit("Worked")).otherwise(F.lit("Scheduled")).alias("Type_Hours"),
        full_name("LastName", "FirstName").alias("Employee_Name"),
        week_number("Business_Date").alias("Week"),
        F.year("Business_Date").alias("Year"),
        F.col("ot").alias("over_time"),
    )
    # Weekly total beside each row; the correlation never matches a null name.
    from pyspark.sql import Window
    w = Window.partitionBy("Store_Id", "Employee_Name", "Week", "Year")
    return t.select(
        "Store_Id", "Business_date", _d("Total_Hours").alias("Total_Hours"), "Type_Hours", "Employee_Name",
        "Week", "Year",
        F.when(F.col("Employee_Name").isNotNull(), F.sum("Total_Hours").over(w)).cast("double").alias("Total_Hours_Week"),
        _d("over_time").alias("over_time"),
    )


# ---------------------------------------------------------------------------
# R5 hourly sales detail
# ---------------------------------------------------------------------------
def category_names(categories: DataFrame) -> DataFrame:
    """Category and parent-category names per (StoreId, CategoryId): the two
    LEFT self-joins of the category master, folded into one small dimension."""
    cm = categories.select("StoreId", "CategoryId", F.col("ParentCategoryId").alias("pid"),
                           F.col("Name").alias("Category"))
    cmp = categories.select(F.col("StoreId").alias("p_store"), F.col("CategoryId").alias("p_id"),
                            F.col("Name").alias("Category_Parent"))
    j = cm.join(cmp, (F.col("p_id") == F.col("pid")) & (F.col("p_store") == F.col("StoreId")), "left")
    return j.select("StoreId", "CategoryId", "Category", "Category_Parent")


def hourly_sales(sales_summary: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    # One aggregate gives a product's TOP 1 number and its distinct (name, category) rows, which are then opened again.
    of_product = products.groupBy("StoreId", "ProductId").agg(
        F.min(F.struct("ItemNumber")).alias("first"), F.collect_set(F.struct(F.col("Name").alias("Product_name"), "CategoryId")).alias("names"))
    pm = of_product.select("StoreId", "ProductId", F.col("first.ItemNumber").alias("Product_Number"), F.inline("names"))
    # A product without a store or id meets no sale.
    pm = pm.select("StoreId", "ProductId", "Product_name", "Product_Number")
    cats = category_names(categories)
    j = (sales_summary.join(pm, ["ProductId", "StoreId"], "inner")
         .join(cats, ["CategoryId", "StoreId"], "left"))
    return j.select(
        F.col("StoreId").alias("Store_Id"), F.col("Business_Date").alias("Business_date"), "HourNo", "Division",
        "Product_Number", _d("AmountSold").alias("Amount_Sold"), F.col("QuantitySold").alias("Quantity_Sold"),
        _d("AmountReturned").alias("Amount_Returned"), F.col("QuantityReturned").alias("Quantity_Returned"),
        F.col("RedemptionTicketsRedeemed").alias("Redemption_Tickets_Redeemed"),
        _d("DiscountAmountApplied").alias("Discount_Amount_Applied"),
        F.col("RevenueCenter").alias("Revenue_Center"), "Category", "Category_Parent", "Product_name",
    )


# ---------------------------------------------------------------------------
# R6 returns detail
# ---------------------------------------------------------------------------
def returns_report(transactions: DataFrame, employees: DataFrame, products: DataFrame,
                   categories: DataFrame) -> DataFrame:
    tm = transactions.filter(F.col("LineQuantitySold") < 0)
    em = employees.select(F.col("StoreId"), F.col("EmployeeId").alias("EmpId"),
                          full_name("LastName", "FirstName").alias("Employee_Name"))
    ems = employees.select(F.col("StoreId").alias("a_store"), F.col("EmployeeId").alias("a_emp"),
                           full_name("LastName", "FirstName").alias("Authorized_By"))
    pm = products.select(F.col("StoreId"), F.col("ProductId").alias("LineProductId"),
                         F.col("Name").alias("Product"), F.col("CategoryId"))
    cm = categories.select("StoreId", "CategoryId", F.col("Name").alias("Category"))
    j = (tm.join(em, ["StoreId", "EmpId"], "inner")
         .join(ems, (F.col("a_store") == F.col("StoreId")) & (F.col("a_emp") == F.col("AuthByEmpNo")), "left")
         .join(pm, ["StoreId", "LineProductId"], "inner")
         .join(cm, ["StoreId", "CategoryId"], "left"))
    rows = j.select(
        F.col("StoreId").alias("Store_Id"), F.col("Business_Date").alias("Business_date"),
        F.col("ReceiptNumber").alias("Receipt_Number"), clock_text("TransactionDateTime").alias("Hour"),
        "Employee_Name", "Division", "Product",
        F.abs("LineQuantitySold").cast("double").alias("Quantity"),
        F.abs("LineAmountPaid").cast("double").alias("Amount_Paid"),
        F.abs("RefundAmount").cast("double").alias("Refund_Amount"),
        "Authorized_By", "RefNo", "RefundReason", "Category", "LineNumber",
    )
    # DISTINCT includes the line number, which the report then drops.
    return rows.distinct().drop("LineNumber")


# ---------------------------------------------------------------------------
# R7 end-of-day balance
# ---------------------------------------------------------------------------
def _debit(df: DataFrame, tender: Column, amount: Column) -> DataFrame:
    return df.select(
        F.col("StoreId").alias("Store_Id"), F.col("Business_Date").alias("Business_date"),
        tender.alias("Tender_Type"), amount.cast("double").alias("Amount_Debit"),
        F.lit(0).alias("Parent_Category_Number"), F.lit("").alias("Parent_Category_Name"),
        F.lit(0).alias("Category_Number"), F.lit("").alias("Category_Name"),
        F.lit(0.0).alias("Amount_Credit"), F.lit("Debits").alias("DC"))


def income_debits(income: DataFrame, excluded=EXCLUDED_TENDERS) -> DataFrame:
    g = (income.filter(~F.col("TenderType").isin(list(excluded)))
         .groupBy("StoreId", "Business_Date", "TenderType").agg(F.sum("Amount").alias("amt")))
    return _debit(g, F.col("TenderType"), F.col("amt"))


def deposits_redeemed(bookings: DataFrame, transactions: DataFrame) -> DataFrame:
    """Bookings x transactions on store and event, booking date after the sale.

    Both sides are first reduced to (store, event, date[, tender]) counts and
    sums, so the inequality join pairs dates, not rows; the weighted sum equals
    the sum over row pairs.  Grouping keeps the hidden tender type (A11).
    """
    b = (bookings.filter(F.col("Status") != "Canceled")
         .groupBy("StoreId", "EventRefId", F.col("Business_Date").alias("b_date"))
         .agg(F.count(F.lit(1)).alias("n_b")))
    t = (transactions.groupBy("StoreId", "EventRefId", F.col("Business_Date").alias("t_date"), "TenderType")
         .agg(F.sum("LineAmountPaid").alias("amt")))
    j = b.join(t, ["StoreId", "EventRefId"], "inner").filter(F.col("b_date") > F.col("t_date"))
    g = (j.groupBy("StoreId", F.col("b_date").alias("Business_Date"), "TenderType")
         .agg(F.sum(F.col("amt") * F.col("n_b")).alias("amt")))
    return _debit(g, F.lit("Birthday Deposits Redeemed"), F.col("amt"))


def tax_by_day(transactions: DataFrame) -> DataFrame:
    """A4: per-receipt tax and gratuity repeated on each line are counted once.

    One pass: the distinct amounts of a receipt, a handful, are kept as a set
    per receipt beside the scan and summed there, then per day, and each day
    gives its two rows.  (Two DISTINCT sums would copy every line first.)
    """
    receipts = (transactions.groupBy("StoreId", "ReceiptNumber", "Business_Date")
                .agg(F.collect_set("TaxAmount").alias("taxes"), F.collect_set("GratuityAmount").alias("grats")))
    total = {c: transactions.select(F.sum(c)).schema[0].dataType for c in ("TaxAmount", "GratuityAmount")}

    def of(amounts: str, column: str) -> Column:
        zero = F.lit(0).cast(total[column])         # no amount at all is null, as SUM has it
        return F.when(F.size(amounts) > 0, F.aggregate(amounts, zero, lambda acc, x: (acc + x).cast(total[column])))

    day = (receipts.groupBy("StoreId", "Business_Date")
           .agg((F.sum(of("taxes", "TaxAmount")) * -1).alias("tax"), (F.sum(of("grats", "GratuityAmount")) * -1).alias("grat")))
    kinds = F.array(F.struct(F.lit("IL Sales Tax").alias("kind"), F.col("tax").alias("amt")),
                    F.struct(F.lit("Gratuity").alias("kind"), F.col("grat").alias("amt")))
    return _debit(day.select("StoreId", "Business_Date", F.inline(kinds)), F.col("kind"), F.col("amt"))


def deposits_received(transactions: DataFrame, bookings: DataFrame) -> DataFrame:
    """Pairs with a different date.  For a sale date d the number of birthday
    bookings on another date is (all bookings of the event) - (bookings on d),
    so the ``<>`` join becomes two equi-joins on pre-aggregated sides.  A null
    date on either side differs from no date, as ``<>`` has it."""
    bb = bookings.filter((F.col("IsBirthdayEvent") == 1) & F.col("Business_Date").isNotNull())
    transactions = transactions.filter(F.col("Business_Date").isNotNull())
    per_day = (bb.groupBy("StoreId", "EventRefId", F.col("Business_Date"))
               .agg(F.count(F.lit(1)).alias("n_day")))
    total = bb.groupBy("StoreId", "EventRefId").agg(F.count(F.lit(1)).alias("n_all"))
    t = (transactions.groupBy("StoreId", "EventRefId", "Business_Date")
         .agg(F.sum("LineAmountPaid").alias("amt")))
    j = (t.join(total, ["StoreId", "EventRefId"], "inner")
         .join(per_day, ["StoreId", "EventRefId", "Business_Date"], "left")
         .withColumn("w", F.col("n_all") - F.coalesce(F.col("n_day"), F.lit(0)))
         .filter(F.col("w") > 0))
    g = (j.groupBy("StoreId", "Business_Date")
         .agg((F.sum(F.col("amt") * F.col("w")) * -1).alias("amt")))
    return _debit(g, F.lit("Birthday Deposits Received"), F.col("amt"))


def category_credits(sales_summary: DataFrame, categories: DataFrame) -> DataFrame:
    cm = categories.select("StoreId", "CategoryId", F.col("ParentCategoryId").alias("pid"),
                           F.col("CategoryNumber").alias("cm_num"), F.col("Name").alias("cm_name"))
    cmp = categories.select(F.col("StoreId").alias("p_store"), F.col("CategoryId").alias("p_id"),
                            F.col("CategoryNumber").alias("p_num"), F.col("Name").alias("p_name"))
    cats = (cm.join(cmp, (F.col("pid") == F.col("p_id")) & (F.col("StoreId") == F.col("p_store")), "inner")
            .select("StoreId", "CategoryId", "cm_num", "cm_name", "p_num", "p_name"))
    # Sum sales per (store, date, category) first; the dimension join then
    # touches one row per group instead of one per sale line.
    s = (sales_summary.groupBy("StoreId", "Business_Date", "CategoryId")
         .agg(F.sum(F.col("AmountSold") - F.col("AmountReturned")).alias("amt")))
    j = s.join(cats, ["StoreId", "CategoryId"], "inner")
    g = (j.groupBy("StoreId", "p_num", "p_name", "cm_num", "cm_name", "Business_Date")
         .agg(F.sum("amt").alias("amt")))
    return g.select(
        F.col("StoreId").alias("Store_Id"), F.col("Business_Date").alias("Business_date"),
        F.lit("").alias("Tender_Type"), F.lit(0.0).alias("Amount_Debit"),
        F.col("p_num").alias("Parent_Category_Number"),
        F.col("p_name").alias("Parent_Category_Name"),
        F.col("cm_num").alias("Category_Number"),
        F.col("cm_name").alias("Category_Name"),
        F.col("amt").cast("double").alias("Amount_Credit"), F.lit("Credits").alias("DC"))


def end_of_day_balance(income: DataFrame, bookings: DataFrame, transactions: DataFrame,
                       sales_summary: DataFrame, categories: DataFrame) -> DataFrame:
    return (income_debits(income)
            .unionByName(deposits_redeemed(bookings, transactions))
            .unionByName(tax_by_day(transactions))
            .unionByName(deposits_received(transactions, bookings))
            .unionByName(category_credits(sales_summary, categories)))
