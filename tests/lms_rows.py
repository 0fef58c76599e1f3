"""Rows in the layout of the learning-management extract."""

from millrace.plans import lms

DEFAULT = {
    "Student_ID": "1001", "Name": "John Doe", "Age": 16, "Gender": "M", "Grade_Level": "9",
    "Course_ID": "C071", "Course_Name": "Introduction to Music",
    "Enrollment_Date": "9/1/2023", "Completion_Date": "12/15/2023", "Status": "Completed",
    "Final_Grade": "A-", "Attendance_Rate": 95, "Time_Spent_on_Course_hrs": 45,
    "Assignments_Completed": 4, "Quizzes_Completed": 5, "Forum_Posts": 15, "Messages_Sent": 10,
    "Quiz_Average_Score": 88, "Assignment_Scores": "[85, 90, 88, 92]",
    "Assignment_Average_Score": 88.75, "Project_Score": 85, "Extra_Credit": 5,
    "Overall_Performance": 90, "Feedback_Score": 4.5, "Parent_Involvement": "High",
    "Demographic_Group": "Urban", "Internet_Access": "Yes", "Learning_Disabilities": "None",
    "Preferred_Learning_Style": "Visual", "Language_Proficiency": "Advanced",
    "Participation_Rate": "80%", "Completion_Time_Days": 105, "Performance_Score": 55.5,
    "Course_Completion_Rate": 88.1,
}
assert list(DEFAULT) == lms.EXTRACT.names


def row(student="1001", course="C071", **changes):
    return DEFAULT | {"Student_ID": student, "Course_ID": course} | changes


def csv_text(*rows):
    def cell(value):
        if value is None:
            return ""
        return f'"{value}"' if "," in str(value) else str(value)

    lines = [",".join(DEFAULT)] + [",".join(cell(v) for v in r.values()) for r in rows]
    return "".join(f"{line}\r\n" for line in lines)


def frame(spark, *rows, day="2024-01-15"):
    """Bronze rows of one batch."""
    casts = {"double": float, "int": int, "string": str}
    data = [
        [None if r[f.name] is None else casts[f.dataType.simpleString()](r[f.name]) for f in lms.EXTRACT]
        + [day, day, day]
        for r in rows
    ]
    return spark.createDataFrame(data, lms.BRONZE)
