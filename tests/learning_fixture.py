"""Small raw files with one row per rule."""

from __future__ import annotations

import os

FILES = {
    "courses.csv": """code_module,code_presentation,module_presentation_length
AAA,2013J,268
 aaa ,2013j,268
BBB,2014B,234
CCC,2014J,0
""",
    "assessments.csv": """code_module,code_presentation,id_assessment,assessment_type,date,weight
 aaa ,2013j,1,tma,19,10
AAA,2013J,2,Exam,?,100
AAA,2013J,3,CMA,40,90
AAA,2013J,3,CMA,40,90
AAA,2013J,4,TMA,50,10
AAA,2013J,4,TMA,50,20
AAA,2013J,0,TMA,50,10
AAA,2013J,x,TMA,50,10
AAA,2013J,5,TMA,50,101
AAA,2013J,6,TMA,1001,10
AAA,2013J,7,QUIZ,60,10
BBB,2014B,8,TMA,70,87
BBB,2014B,9,Exam,,50
ZZZ,2099Z,10,TMA,80,100
""",
    "vle.csv": """id_site,code_module,code_presentation,activity_type,week_from,week_to
100,AAA,2013J, Resource ,?,?
101,BBB,2014B,quiz,1,2
101,bbb,2014b,QUIZ,1,2
102,BBB,2014B,,1,2
""",
    "studentInfo.csv": """code_module,code_presentation,id_student,gender,region,highest_education,imd_band,age_band,num_of_prev_attempts,studied_credits,disability,final_result
AAA,2013J,11,M,Wales ,A Level,0-10%,0-35,0,60,N,Pass
aaa,2013j,11,M,Wales ,A Level,0-10%,0-35,0,60,N,Pass
AAA,2013J,12,f,Ireland,HE,?,35-55,1,130,?,Withdrawn
BBB,2014B,11,M,Wales,A Level,0-10%,0-35,1,30,N,Fail
BBB,2014B,13,M,Wales,HE,20-30%,0-35,0,0,Y,Pass
BBB,2014B,14,X,Wales,HE,20-30%,0-35,0,60,Y,Pass
""",
    "studentRegistration.csv": """code_module,code_presentation,id_student,date_registration,date_unregistration
AAA,2013J,11,-30,
AAA,2013J,12,?,12
BBB,2014B,11,10,5
BBB,2014B,15,,
""",
    "studentAssessment.csv": """id_assessment,id_student,date_submitted,is_banked,score
1,11,18,0,80
1,12,-5,0,?
2,11,200,1,
3,11,-366,0,50
3,12,1826,0,50
8,11,6,0,abc
8,12,60,0,NaN
9,11,61,0,101
9,12,61,2,50
10,11,70,,50
1,99,20,0,60
77,11,20,0,60
""",
    "studentVle.csv": """code_module,code_presentation,id_student,id_site,date,sum_click
AAA,2013J,11,100,-8,1
AAA,2013J,11,100,-7,1
AAA,2013J,11,100,-1,1
AAA,2013J,11,100,0,3
AAA,2013J,11,100,0,4
AAA,2013J,11,100,1,1
AAA,2013J,11,100,7,1
AAA,2013J,11,100,8,1
AAA,2013J,11,100,600,2
AAA,2013J,11,100,9,0
AAA,2013J,98,100,3,5
AAA,2013J,99,100,3,6
BBB,2014B,11,101,3,10
""",
}


def write(folder: str) -> str:
    os.makedirs(folder, exist_ok=True)
    for name, text in FILES.items():
        with open(os.path.join(folder, name), "w") as handle:
            handle.write(text)
    return folder
