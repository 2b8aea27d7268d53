"""Codes and their readable labels."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The codes of platform profiles and catalogues, and what they stand for.
GENDER = {"m": "Male", "f": "Female", "t": "Transgender", "b": "Binary", "nb": "Non-binary/non-conforming", "o": "Other/Prefer Not to Say"}
EDUCATION = {
    "p": "Doctorate",
    "m": "Master's or professional degree",
    "b": "Bachelor's degree",
    "a": "Associate degree",
    "hs": "Secondary/high school",
    "jhs": "Junior secondary/junior high/middle school",
    "el": "Elementary/primary school",
    "none": "No formal education",
    "other": "Other education",
    "o": "Other education",
    "p_se": "Doctorate in science or engineering",
    "p_oth": "Doctorate in another field",
}
COMPANY_SIZE = {
    1: "Small/Start-up (1+ employees)",
    9: "Small/Home office (1-9 employees)",
    99: "Small (10-99 employees)",
    999: "Small to medium-sized (100-999 employees)",
    9999: "Medium-sized (1000-9999 employees)",
    10000: "Large Enterprise (10,000+ employees)",
    0: "Other (N/A or Don't know)",
}
YEARS_EXPERIENCE = {2: "Less than 2 years", 5: "2-5 years", 10: "6 - 10 years", 15: "11 - 15 years", 20: "16 - 20 years", 21: "More than 20 years", 0: "Prefer not to say"}
# Departments in the catalogue of open courses.
OPEN_DEPARTMENT = {
    "1": "Civil and Environmental Engineering",
    "2": "Mechanical Engineering",
    "3": "Materials Science and Engineering",
    "4": "Architecture",
    "5": "Chemistry",
    "6": "Electrical Engineering and Computer Science",
    "7": "Biology",
    "8": "Physics",
    "9": "Brain and Cognitive Sciences",
    "10": "Chemical Engineering",
    "11": "Urban Studies and Planning",
    "12": "Earth, Atmospheric, and Planetary Sciences",
    "14": "Economics",
    "15": "Sloan School of Management",
    "16": "Aeronautics and Astronautics",
    "17": "Political Science",
    "18": "Mathematics",
    "20": "Biological Engineering",
    "21A": "Anthropology",
    "21G": "Global Studies and Languages",
    "21H": "History",
    "21L": "Literature",
    "21M": "Music and Theater Arts",
    "22": "Nuclear Science and Engineering",
    "24": "Linguistics and Philosophy",
    "CC": "Concourse",
    "CMS-W": "Comparative Media Studies/Writing",
    "EC": "Edgerton Center",
    "ES": "Experimental Study Group",
    "ESD": "Engineering Systems Division",
    "HST": "Health Sciences and Technology",
    "IDS": "Institute for Data, Systems, and Society",
    "MAS": "Media Arts and Sciences",
    "PE": "Athletics, Physical Education and Recreation",
    "RES": "Supplemental Resources",
    "STS": "Science, Technology, and Society",
    "WGS": "Women's and Gender Studies",
}
# Departments in the catalogue of courses for credit.
COURSE_DEPARTMENT = {
    "1": "Civil and Environmental Engineering",
    "2": "Mechanical Engineering",
    "3": "Materials Science and Engineering",
    "4": "Architecture",
    "5": "Chemistry",
    "6": "Electrical Engineering and Computer Science",
    "7": "Biology",
    "8": "Physics",
    "9": "Brain and Cognitive Sciences",
    "10": "Chemical Engineering",
    "11": "Urban Studies and Planning",
    "12": "Earth, Atmospheric, and Planetary Sciences",
    "14": "Economics",
    "15": "Management",
    "16": "Aeronautics and Astronautics",
    "17": "Political Science",
    "18": "Mathematics",
    "20": "Biological Engineering",
    "21A": "Anthropology",
    "21G": "Global Languages",
    "21H": "History",
    "21L": "Literature",
    "21M": "Music and Theater Arts",
    "22": "Nuclear Science and Engineering",
    "24": "Linguistics and Philosophy",
    "CC": "Concourse",
    "CMS-W": "Comparative Media Studies/Writing",
    "EC": "Edgerton Center",
    "ES": "Experimental Study Group",
    "ESD": "Engineering Systems Division",
    "HST": "Medical Engineering and Science",
    "IDS": "Data, Systems, and Society",
    "MAS": "Media Arts and Sciences",
    "PE": "Athletics, Physical Education and Recreation",
    "SP": "Special Programs",
    "STS": "Science, Technology, and Society",
    "WGS": "Women's and Gender Studies",
}
RESOURCE_TYPES = {"Document": "pdf|docx|doc|txt|rtf", "Video": "mp4|mov|avi|webm|m4v", "Image": "jpg|jpeg|png|gif|svg", "Archive": "zip|tar|gz"}


def label(code: Column | str, labels: dict, default: Column | None = None) -> Column:
    """The label of a code; null, or ``default``, for a code without one.

    Genders, education and course departments have no default; sizes, years and open departments keep the code as text.
    """
    table = F.create_map(*map(F.lit, chain(*labels.items())))
    found = F.try_element_at(table, F.col(code) if isinstance(code, str) else code)
    return found if default is None else F.coalesce(found, default)


def resource_type(url: Column | str, known: Column | str) -> Column:
    """The known type, else by the extension of the url, else Other."""
    url = F.lower(F.col(url) if isinstance(url, str) else url)
    out = F.when((F.col(known) if isinstance(known, str) else known).isNotNull(), F.col(known) if isinstance(known, str) else known)
    for name, extensions in RESOURCE_TYPES.items():
        out = out.when(url.rlike(rf"\.({extensions})$"), F.lit(name))
    return out.otherwise(F.lit("Other"))
