"""Pay, review, risk, leave and overview reports."""

from __future__ import annotations

from tenura.plans import analytics
from tenura.plans.dimensions import dim_leave_type
from workload.registry import query
from workload.roles import AS_OF

# an employee with tenure as the reports see it
STAFF = f""", staff AS (
  SELECT employee_id, concat_ws(' ', first_name, last_name) AS full_name, job_title, department_id, status,
         round((DATE '{AS_OF}' - hire_date) / 365, 2) AS tenure_years
  FROM employees)"""

RISK = (
    STAFF
    + """, risk AS (
  SELECT s.employee_id, full_name, job_title, r.avg_rating, p.amount, tenure_years, l.total_leave_days,
         CASE WHEN r.avg_rating < 3 THEN 1 ELSE 0 END AS low_rating,
         CASE WHEN CAST(p.amount AS DOUBLE)
                   < (SELECT avg(amount) FROM salaries WHERE end_date IS NULL) * 0.8 THEN 1 ELSE 0 END AS low_pay,
         CASE WHEN l.total_leave_days > 20 THEN 1 ELSE 0 END AS high_leave,
         CASE WHEN tenure_years > 5 THEN 1 ELSE 0 END AS long_tenure
  FROM staff s
  LEFT JOIN (SELECT employee_id, amount FROM salaries WHERE end_date IS NULL) p USING (employee_id)
  LEFT JOIN (SELECT employee_id, round(CAST(avg(rating) AS DECIMAL(28,12)), 1) AS avg_rating
             FROM reviews GROUP BY 1) r USING (employee_id)
  LEFT JOIN (SELECT employee_id, sum(end_date - start_date) AS total_leave_days
             FROM leaves WHERE status = 'approved' GROUP BY 1) l USING (employee_id)
  WHERE s.status = 'active'),
scored AS (
  SELECT *, CAST(2 * low_rating + 2 * low_pay + high_leave + long_tenure AS INTEGER) AS risk_score FROM risk),
levelled AS (
  SELECT employee_id, full_name, job_title, CAST(avg_rating AS DOUBLE) AS avg_rating,
         CAST(amount AS DOUBLE) AS amount, tenure_years, risk_score,
         CASE WHEN risk_score >= 4 THEN 'HIGH' WHEN risk_score >= 2 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
  FROM scored)"""
)
RISK_ROLES = "employees salaries reviews leaves"

TREND = """, trend AS (
  SELECT *, lag(rating) OVER (PARTITION BY employee_id ORDER BY review_date, review_id) AS previous_rating
  FROM reviews),
summary AS (
  SELECT employee_id, CAST(round(CAST(avg(rating) AS DECIMAL(28,12)), 1) AS DOUBLE) AS avg_rating,
         CAST(round(CAST(avg(rating - previous_rating) AS DECIMAL(28,12)), 2) AS DOUBLE) AS avg_improvement,
         count(review_id) AS total_reviews
  FROM trend GROUP BY employee_id)"""

PAY_BY_DEPARTMENT = """
  SELECT department_name, count(employee_id) AS headcount,
         CAST(round(CAST(avg(amount) AS DECIMAL(28,6)), 2) AS DOUBLE) AS avg_salary,
         CAST(min(amount) AS DOUBLE) AS min_salary, CAST(max(amount) AS DOUBLE) AS max_salary,
         round(stddev_samp(CAST(amount AS DOUBLE)), 2) AS salary_stddev
  FROM employees LEFT JOIN (SELECT employee_id, amount FROM {salaries} WHERE end_date IS NULL) USING (employee_id)
  LEFT JOIN departments USING (department_id)
  GROUP BY department_name"""


def staff(r):
    return analytics.enrich_employees(r.employees, AS_OF)


def risk(r, ordered=False):
    return analytics.attrition_risk(staff(r), r.salaries, r.reviews, r.leaves, ordered)


@query("salary_distribution", "employees salaries departments", PAY_BY_DEPARTMENT.format(salaries="salaries"))
def _(r):
    return analytics.salary_distribution(r.employees, r.salaries, r.departments)


@query(
    "salary_distribution_fan_out",
    "employees loose_salaries departments",
    PAY_BY_DEPARTMENT.format(salaries="loose_salaries"),
)
def _(r):
    return analytics.salary_distribution(r.employees, r.loose_salaries, r.departments)


@query(
    "enrich_employees",
    "employees",
    STAFF + "SELECT employee_id, full_name, tenure_years FROM staff",
)
def _(r):
    return staff(r).select("employee_id", "full_name", "tenure_years")


@query(
    "review_trend",
    "reviews",
    """
    SELECT review_id, employee_id, CAST(review_date AS VARCHAR) AS review_date, rating,
           lag(rating) OVER by_day_and_id AS previous_rating,
           rating - lag(rating) OVER by_day_and_id AS rating_change,
           rank() OVER (PARTITION BY employee_id ORDER BY review_date) AS review_rank
    FROM reviews
    WINDOW by_day_and_id AS (PARTITION BY employee_id ORDER BY review_date, review_id)""",
)
def _(r):
    return analytics.review_trend(r.reviews).select(
        "review_id", "employee_id", "review_date", "rating", "previous_rating", "rating_change", "review_rank"
    )


@query(
    "performance_trends",
    "employees reviews",
    STAFF
    + TREND
    + """SELECT employee_id, full_name, job_title, avg_rating, avg_improvement, total_reviews
    FROM staff LEFT JOIN summary USING (employee_id)""",
)
def _(r):
    return analytics.performance_trends(staff(r), r.reviews)


@query(
    "top_performers",
    "employees reviews",
    STAFF
    + TREND
    + """SELECT employee_id, full_name, job_title, avg_rating, avg_improvement, total_reviews
    FROM staff LEFT JOIN summary USING (employee_id)
    ORDER BY avg_rating DESC NULLS LAST, employee_id LIMIT 10""",
)
def _(r):
    return analytics.top_performers(staff(r), r.reviews, 10)


@query("attrition_risk", RISK_ROLES, RISK + "SELECT * FROM levelled")
def _(r):
    return risk(r, ordered=True)


@query("risk_summary", RISK_ROLES, RISK + "SELECT risk_level, count(*) AS count FROM levelled GROUP BY 1")
def _(r):
    return analytics.risk_summary(risk(r))


@query(
    "high_risk_top10",
    RISK_ROLES,
    RISK
    + """SELECT * FROM levelled WHERE risk_level = 'HIGH'
    ORDER BY risk_score DESC, employee_id LIMIT 10""",
)
def _(r):
    return analytics.high_risk(risk(r), 10)


@query(
    "risk_factors",
    RISK_ROLES,
    RISK
    + """SELECT CAST(sum(low_rating) AS BIGINT) AS low_rating, CAST(sum(low_pay) AS BIGINT) AS low_pay,
    CAST(sum(high_leave) AS BIGINT) AS high_leave, CAST(sum(long_tenure) AS BIGINT) AS long_tenure FROM scored""",
)
def _(r):
    return analytics.risk_factors(staff(r), r.salaries, r.reviews, r.leaves)


@query(
    "below_company_average",
    "employees salaries",
    """, paid AS (SELECT employee_id, amount FROM salaries WHERE end_date IS NULL),
    mean AS (SELECT avg(amount) AS pay FROM paid)
    SELECT employee_id, CAST(amount AS DOUBLE) AS amount,
           CAST(round(CAST(pay - amount AS DECIMAL(28,9)), 2) AS DOUBLE) AS below_by
    FROM employees JOIN paid USING (employee_id), mean WHERE amount < pay""",
)
def _(r):
    return analytics.below_company_average(r.employees, r.salaries)


@query(
    "company_average",
    "salaries",
    "SELECT CAST(CAST(avg(amount) AS DECIMAL(28,6)) AS DOUBLE) AS company_avg_salary FROM salaries WHERE end_date IS NULL",
)
def _(r):
    return analytics.company_average(r.salaries)


@query(
    "overview",
    "employees salaries reviews",
    """SELECT (SELECT count(employee_id) FROM employees) AS total_employees,
    (SELECT CAST(round(CAST(avg(amount) AS DECIMAL(28,6)), 2) AS DOUBLE) FROM salaries WHERE end_date IS NULL)
      AS avg_salary,
    (SELECT CAST(round(CAST(avg(rating) AS DECIMAL(28,12)), 1) AS DOUBLE) FROM reviews) AS avg_rating""",
)
def _(r):
    return analytics.overview(r.employees, r.salaries, r.reviews)


@query(
    "headcount_by_department",
    "employees departments",
    """SELECT department_id, department_name, count(*) AS headcount
    FROM employees LEFT JOIN departments USING (department_id) GROUP BY ALL""",
)
def _(r):
    return analytics.headcount_by_department(r.employees, r.departments)


@query(
    "pay_by_department",
    "employees loose_salaries departments",
    """SELECT department_name, CAST(round(CAST(avg(amount) AS DECIMAL(28,6)), 2) AS DOUBLE) AS avg_salary
    FROM loose_salaries s JOIN employees USING (employee_id) JOIN departments USING (department_id)
    WHERE s.end_date IS NULL GROUP BY 1""",
)
def _(r):
    return analytics.pay_by_department(r.employees, r.loose_salaries, r.departments)


@query(
    "pay_by_title",
    "employees loose_salaries",
    """SELECT job_title, count(*) AS headcount,
    CAST(round(CAST(avg(amount) AS DECIMAL(28,6)), 2) AS DOUBLE) AS avg_salary
    FROM employees e LEFT JOIN loose_salaries s ON e.employee_id = s.employee_id AND s.end_date IS NULL
    GROUP BY 1""",
)
def _(r):
    return analytics.pay_by_title(r.employees, r.loose_salaries)


@query(
    "top_earners",
    "employees salaries",
    STAFF
    + """SELECT employee_id, full_name, job_title, CAST(amount AS DOUBLE) AS amount
    FROM salaries LEFT JOIN staff USING (employee_id)
    WHERE end_date IS NULL ORDER BY amount DESC, employee_id LIMIT 10""",
)
def _(r):
    return analytics.top_earners(staff(r), r.salaries, 10)


@query(
    "rating_by_department",
    "employees reviews departments",
    """SELECT department_name, CAST(round(CAST(avg(rating) AS DECIMAL(28,12)), 1) AS DOUBLE) AS avg_rating,
    count(rating) AS rated_reviews
    FROM reviews JOIN employees USING (employee_id) LEFT JOIN departments USING (department_id) GROUP BY 1""",
)
def _(r):
    return analytics.rating_by_department(r.employees, r.reviews, r.departments)


@query(
    "rating_distribution",
    "reviews",
    "SELECT rating, count(*) AS review_count FROM reviews GROUP BY rating",
)
def _(r):
    return analytics.rating_distribution(r.reviews)


@query(
    "leave_patterns",
    "leaves employees departments",
    """SELECT department_name, leave_type,
    CASE WHEN leave_type IN ('annual', 'unpaid') THEN 'personal' WHEN leave_type = 'sick' THEN 'medical'
         ELSE 'parental' END AS category,
    leave_type <> 'unpaid' AS is_paid, count(*) AS requests,
    CAST(sum(end_date - start_date) AS BIGINT) AS total_leave_days
    FROM leaves LEFT JOIN employees USING (employee_id) LEFT JOIN departments USING (department_id)
    GROUP BY ALL""",
)
def _(r):
    return analytics.leave_patterns(r.leaves, r.employees, r.departments, dim_leave_type(r.spark))
