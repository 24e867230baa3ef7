"""Source extracts and staging views."""

from __future__ import annotations

from tenura.plans import extract, staging
from workload.registry import query
from workload.roles import AS_OF


@query(
    "extract_employees",
    "employees departments",
    """SELECT e.employee_id, first_name, last_name, email, CAST(hire_date AS VARCHAR) AS hire_date, job_title,
    status, e.department_id, e.manager_id, CAST(e.created_at AS VARCHAR) AS created_at, department_name, location
    FROM employees e LEFT JOIN departments d ON e.department_id = d.department_id""",
)
def _(r):
    return extract.employees(r.employees, r.departments, ordered=True)


@query(
    "extract_departments",
    "departments employees",
    """SELECT d.department_id, department_name, location, d.manager_id,
    CASE WHEN e.employee_id IS NOT NULL THEN concat(first_name, ' ', last_name) END AS manager_name,
    CAST(d.created_at AS VARCHAR) AS created_at
    FROM departments d LEFT JOIN employees e ON d.manager_id = e.employee_id""",
)
def _(r):
    return extract.departments(r.departments, r.employees, ordered=True)


@query(
    "extract_salaries",
    "salaries",
    """SELECT salary_id, employee_id, CAST(amount AS DOUBLE) AS amount, currency,
    CAST(effective_date AS VARCHAR) AS effective_date, CAST(end_date AS VARCHAR) AS end_date,
    CAST(created_at AS VARCHAR) AS created_at FROM salaries""",
)
def _(r):
    return extract.salaries(r.salaries, ordered=True)


@query(
    "extract_reviews",
    "reviews",
    """SELECT review_id, employee_id, reviewer_id, rating, CAST(review_date AS VARCHAR) AS review_date, comments,
    CAST(created_at AS VARCHAR) AS created_at FROM reviews""",
)
def _(r):
    return extract.reviews(r.reviews, ordered=True)


@query(
    "extract_projects",
    "projects departments",
    """SELECT project_id, project_name, p.department_id, department_name,
    CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date, status,
    CAST(budget AS DOUBLE) AS budget, CAST(p.created_at AS VARCHAR) AS created_at
    FROM projects p LEFT JOIN departments d ON p.department_id = d.department_id""",
)
def _(r):
    return extract.projects(r.projects, r.departments, ordered=True)


@query(
    "extract_assignments",
    "assignments",
    """SELECT emp_project_id, employee_id, project_id, role, CAST(assigned_date AS VARCHAR) AS assigned_date
    FROM assignments""",
)
def _(r):
    return extract.assignments(r.assignments, ordered=True)


@query(
    "extract_approved_leaves",
    "leaves",
    """SELECT leave_id, employee_id, leave_type, CAST(start_date AS VARCHAR) AS start_date,
    CAST(end_date AS VARCHAR) AS end_date, status, CAST(end_date - start_date AS INTEGER) AS leave_days,
    CAST(created_at AS VARCHAR) AS created_at
    FROM leaves WHERE status = 'approved'""",
)
def _(r):
    return extract.approved_leaves(r.leaves, ordered=True)


@query(
    "extract_profile",
    "employees departments salaries reviews projects assignments leaves",
    """SELECT 'employees' AS "table", count(*) AS row_count, 12 AS column_count FROM employees
    UNION ALL SELECT 'departments', count(*), 6 FROM departments
    UNION ALL SELECT 'salaries', count(*), 7 FROM salaries
    UNION ALL SELECT 'reviews', count(*), 7 FROM reviews
    UNION ALL SELECT 'projects', count(*), 9 FROM projects
    UNION ALL SELECT 'emp_projects', count(*), 5 FROM assignments
    UNION ALL SELECT 'leaves', count(*), 8 FROM leaves WHERE status = 'approved'""",
)
def _(r):
    return extract.extract_profile(extract.extract_all(r.source))


@query(
    "staging_employees",
    "employees",
    f"""SELECT employee_id, first_name, last_name, concat(first_name, ' ', last_name) AS full_name,
    lower(email) AS email, CAST(hire_date AS VARCHAR) AS hire_date, job_title, department_id, manager_id, status,
    CAST(created_at AS VARCHAR) AS created_at, CAST(updated_at AS VARCHAR) AS updated_at,
    round((DATE '{AS_OF}' - hire_date) / 365.0, 2) AS tenure_years
    FROM employees WHERE employee_id IS NOT NULL AND email IS NOT NULL""",
)
def _(r):
    return staging.stg_employees(r.employees, AS_OF)


@query(
    "staging_salaries",
    "salaries",
    """SELECT salary_id, employee_id, CAST(amount AS DOUBLE) AS salary_amount, currency,
    CAST(effective_date AS VARCHAR) AS effective_date, CAST(end_date AS VARCHAR) AS end_date,
    end_date IS NULL AS is_current, CAST(created_at AS VARCHAR) AS created_at
    FROM salaries WHERE employee_id IS NOT NULL AND amount > 0""",
)
def _(r):
    return staging.stg_salaries(r.salaries)


@query(
    "staging_departments",
    "departments",
    """SELECT department_id, department_name, coalesce(location, 'Unknown') AS location, manager_id,
    CAST(created_at AS VARCHAR) AS created_at FROM departments WHERE department_id IS NOT NULL""",
)
def _(r):
    return staging.stg_departments(r.departments)
