"""A small guidance corpus and questions with known answers, for the retrieval checks. Own texts."""

from __future__ import annotations

CORPUS = [
    ("doc-noro-kitchen", "Norovirus in kitchens", "Kitchen staff with norovirus vomiting or diarrhea stay off work until 48 hours after the last symptom. Surfaces are cleaned with chlorine."),
    ("doc-campy-poultry", "Campylobacter and poultry", "Campylobacteriosis is mostly linked to undercooked poultry. Ask about barbecue meals and raw milk in the week before onset."),
    ("doc-measles-contacts", "Measles contact prophylaxis", "Measles contacts without immunity receive vaccine within 72 hours or immunoglobulin within six days of exposure."),
    ("doc-tb-masks", "Tuberculosis airborne precautions", "Patients with suspected pulmonary tuberculosis wear a mask and wait in a negative pressure room until three sputum smears are negative."),
    ("doc-legion-towers", "Legionella water sampling", "Legionellosis clusters call for sampling of cooling towers, spa pools and showers before disinfection of the water system."),
    ("doc-mumps-school", "Mumps school exclusion", "Pupils with mumps are excluded from school for five days after the swelling of the parotid gland began."),
    ("doc-dengue-travel", "Dengue after travel", "Travellers with dengue fever protect themselves from mosquito bites for seven days after onset so that local mosquitoes stay uninfected."),
    ("doc-listeria-pregnancy", "Listeria in pregnancy", "Pregnant patients with listeriosis and fever have blood cultures taken and start ampicillin without waiting for results."),
]

QUESTIONS = [
    ("q1", "When may kitchen staff with norovirus return to work?", "doc-noro-kitchen", True),
    ("q2", "How soon must measles contacts receive vaccine or immunoglobulin prophylaxis?", "doc-measles-contacts", True),
    ("q3", "How long are pupils with mumps excluded from school?", "doc-mumps-school", True),
    ("q4", "Which water sampling does a legionellosis cluster call for?", "doc-legion-towers", True),
    ("q5", "Which airborne precautions apply to suspected pulmonary tuberculosis?", "doc-tb-masks", True),
    ("q6", "What is the rabies schedule after a bat scratch?", None, False),
    ("q7", "How are parking permits for visitors issued?", None, False),
]

DOCUMENT_QUESTIONS = [
    ("d1", "kitchen staff norovirus surfaces chlorine"),
    ("d2", "measles contacts vaccine fever rash"),
    ("d3", "school pupils stay home diarrhea vomiting"),
    ("d4", "zebra crossing paint colours"),
]

#: Outbreak windows as rows: facility, condition, first and last day, multiplier. The first two overlap.
WINDOWS = [
    ("FX000001", "Norovirus infection", "2026-03-10", "2026-03-20", 4.0),
    ("FX000001", "Norovirus infection", "2026-03-18", "2026-03-25", 6.0),
    ("FX000002", "RSV infection", "2026-04-01", "2026-04-12", 3.5),
    ("FX000003", "Measles", "2026-05-05", "2026-05-14", 5.0),
    ("FX000001", "RSV infection", "2026-06-01", "2026-06-15", 4.5),
    ("FX001002", "Mumps", "2026-06-10", "2026-06-24", 8.0),
]

#: The data's conditions by playbook.
CONDITION_GROUPS = {
    "enteric": ("Norovirus infection", "Campylobacteriosis", "Giardiasis", "Cryptosporidiosis", "Listeriosis"),
    "respiratory": ("RSV infection", "Legionellosis", "Mumps", "Measles", "Tuberculosis"),
}

#: What the evaluation's notes are written with. Some of it is beyond the rule backend, so that no rate is 1 by construction.
EXPOSURES = ["wedding buffet", "swimming lake", "petting farm", "street market", "care home", "St. Brannoc fair"]
NOTE_TERMS = [
    "watery stools", "pyrexia", "abdominal cramps", "fever", "nausea", "emesis", "jaundice", "fatigue", "dark urine", "coughing fits",
    "cough", "queasiness", "myalgia", "sore throat", "loss of taste", "shortness of breath", "bloody stools",
]
ONSET_PHRASES = ["Symptom onset reported as "] * 6 + ["Unwell since "]
TRAVEL_PHRASES = [". Reports recent travel abroad.", ". Reports recent travel by ship.", ". Came back from abroad."]
