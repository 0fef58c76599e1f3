"""The learning-management extract: schema, null policy, metrics, star schema."""

from __future__ import annotations

from pyspark.sql import types as T

from millrace.operators.lastwriter import RANKS, ranks_type
from millrace.plans.specs import ConformSpec, StarSpec, TableSpec, schema_of

# Column names, types, defaults, weights, labels and date format
# of the extract and its star schema.

EXTRACT = schema_of("""
    Student_ID string, Name string, Age int, Gender string, Grade_Level string,
    Course_ID string, Course_Name string, Enrollment_Date string, Completion_Date string,
    Status string, Final_Grade string, Attendance_Rate double,
    Time_Spent_on_Course_hrs double, Assignments_Completed int, Quizzes_Completed int,
    Forum_Posts int, Messages_Sent int, Quiz_Average_Score double, Assignment_Scores string,
    Assignment_Average_Score double, Project_Score double, Extra_Credit double,
    Overall_Performance double, Feedback_Score double, Parent_Involvement string,
    Demographic_Group string, Internet_Access string, Learning_Disabilities string,
    Preferred_Learning_Style string, Language_Proficiency string, Participation_Rate string,
    Completion_Time_Days int, Performance_Score double, Course_Completion_Rate double
""")

KEYS = ("Student_ID", "Course_ID")
CRITICAL = ("Student_ID", "Course_ID", "Enrollment_Date")
BATCH = "Processing_Date"
LAST_BATCH = "Last_Batch_Date"  # the batch that changed the row last, whichever its date
NEWEST_BATCH = "Newest_Batch_Date"  # the newest batch that brought the row

DEFAULTS = {
    "Age": 0,
    "Gender": "Unknown",
    "Status": "In-progress",
    "Final_Grade": "N/A",
    "Attendance_Rate": 0.0,
    "Time_Spent_on_Course_hrs": 0.0,
    "Assignments_Completed": 0,
    "Quizzes_Completed": 0,
    "Forum_Posts": 0,
    "Messages_Sent": 0,
    "Quiz_Average_Score": 0.0,
    "Assignment_Average_Score": 0.0,
    "Project_Score": 0.0,
    "Extra_Credit": 0.0,
    "Overall_Performance": 0.0,
    "Feedback_Score": 0.0,
    "Parent_Involvement": "Unknown",
    "Demographic_Group": "Unknown",
    "Internet_Access": "Unknown",
    "Learning_Disabilities": "Unknown",
    "Preferred_Learning_Style": "Unknown",
    "Language_Proficiency": "Unknown",
    "Participation_Rate": "Unknown",
    "Completion_Time_Days": 0,
    "Performance_Score": 0.0,
    "Course_Completion_Rate": 0.0,
    "Completion_Date": "12/31/9999",
}

MANDATORY = tuple(c for c in DEFAULTS if c not in ("Completion_Date", "Completion_Time_Days"))

CONFORM = ConformSpec(
    critical=CRITICAL,
    defaults=DEFAULTS,
    start="Enrollment_Date",
    end="Completion_Date",
    date_format="M/d/yyyy",
    days="Completion_Time_Days",
    score="Performance_Score",
    weights={"Quiz_Average_Score": "0.2", "Assignment_Average_Score": "0.2", "Project_Score": "0.1"},
    label="Course_Completion_Rate",
    label_limit=90,
    label_within="On-Time",
    label_beyond="Delayed",
    mandatory=MANDATORY,
)

DIM_STUDENT = TableSpec(
    name="dim_student",
    keys=("Student_ID",),
    schema=schema_of("""
        Student_ID string, Name string, Age int, Gender string, Demographic_Group string,
        Internet_Access string, Learning_Disabilities string, Language_Proficiency string,
        Parent_Involvement string
    """),
    newest_by=("Enrollment_Date",),
)

DIM_COURSE = TableSpec(
    name="dim_course",
    keys=("Course_ID",),
    schema=schema_of("Course_ID string, Course_Name string, Grade_Level string"),
    newest_by=("Enrollment_Date",),
)

FACT = TableSpec(
    name="fact_student_performance",
    keys=KEYS,
    schema=schema_of("""
        Student_ID string, Course_ID string, Enrollment_Date date, Completion_Date date,
        Status string, Final_Grade string, Attendance_Rate double,
        Time_Spent_on_Course_hrs double, Assignments_Completed int, Quizzes_Completed int,
        Forum_Posts int, Messages_Sent int, Quiz_Average_Score double, Assignment_Scores string,
        Assignment_Average_Score double, Project_Score double, Extra_Credit double,
        Overall_Performance double, Feedback_Score double, Completion_Time_Days int,
        Performance_Score double, Course_Completion_Rate string, Processing_Date date
    """),
    first_wins=("Processing_Date",),
    partition_by="Processing_Date",
)

STAR = StarSpec(dimensions=(DIM_STUDENT, DIM_COURSE), fact=FACT)


# Tables of the layers, derived from the extract's schema.

def _with(schema: T.StructType, ddl: str) -> T.StructType:
    return T.StructType([*schema.fields, *schema_of(ddl).fields])


FOLDED = tuple(f.name for f in EXTRACT.fields if f.name not in KEYS)

_RETYPED = {
    "Enrollment_Date": T.DateType(),
    "Completion_Date": T.DateType(),
    "Course_Completion_Rate": T.StringType(),
}

LANDING = _with(EXTRACT, f"Source_File string, Source_Modified timestamp, {BATCH} string")
BRONZE = _with(EXTRACT, f"{BATCH} string, {LAST_BATCH} string, {NEWEST_BATCH} string")
SILVER = T.StructType(
    [T.StructField(f.name, _RETYPED.get(f.name, f.dataType)) for f in BRONZE.fields]
)
#: What bronze stores: of each column also the rank of the drop that wrote it last.
BRONZE_STORED = T.StructType([*BRONZE.fields, T.StructField(RANKS, ranks_type(FOLDED, T.LongType()))])
REJECTS = _with(EXTRACT, f"Stage string, Reason string, {BATCH} string")
LINE_REJECTS = schema_of(f"Source_File string, Line string, Reason string, {BATCH} string")
