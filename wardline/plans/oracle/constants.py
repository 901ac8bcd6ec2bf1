"""Values the reference SQL needs, written out here so that a slip in the library shows."""

# Fixed values, in the order in which they are declared.
BMI_BANDS = ((16.0, 'Severe Thinness'),
 (17.0, 'Moderate Thinness'),
 (18.5, 'Mild Thinness'),
 (25.0, 'Normal'),
 (30.0, 'Overweight'),
 (35.0, 'Obese Class I'),
 (40.0, 'Obese Class II'))
BMI_TOP_BAND = 'Obese Class III'
DOSAGE_FORMS = '\\s*(TABLET|CAPSULE|INJECTION|SOLUTION|SUSPENSION|CREAM|OINTMENT|PATCH|INHALER)\\s*'
ICD_CHAPTER_MAX = {'C': 96, 'D': 89, 'E': 89, 'H': 95, 'K': 95, 'P': 96, 'T': 88}
ICD_STRICT = '^[A-Z]\\d{2}(\\.\\d{1,4}[A-Z]?)?$'
SALT_SUFFIXES = ('HCL',
 'HYDROCHLORIDE',
 'SODIUM',
 'POTASSIUM',
 'SULFATE',
 'ACETATE',
 'TARTRATE',
 'MALEATE',
 'MESYLATE',
 'BESYLATE',
 'FUMARATE')
STRENGTHS = '\\s*\\d+\\s*(MG|MCG|ML|G|%|UNITS?)\\s*'
INTERACTIONS = (('WARFARIN', 'ASPIRIN', 'MAJOR: Increased bleeding risk. Monitor INR closely.'),
 ('WARFARIN', 'IBUPROFEN', 'MAJOR: Increased bleeding risk. Avoid combination if possible.'),
 ('WARFARIN',
  'AMIODARONE',
  'MAJOR: Significantly increases warfarin levels. Reduce warfarin dose by 30-50%.'),
 ('WARFARIN', 'FLUCONAZOLE', 'MAJOR: Inhibits warfarin metabolism. Monitor INR.'),
 ('WARFARIN', 'METRONIDAZOLE', 'MAJOR: Inhibits warfarin metabolism. Consider dose reduction.'),
 ('METFORMIN', 'CONTRAST_DYE', 'MAJOR: Risk of lactic acidosis. Hold metformin 48h before/after contrast.'),
 ('METFORMIN', 'ALCOHOL', 'MODERATE: Increased risk of lactic acidosis and hypoglycemia.'),
 ('LISINOPRIL', 'POTASSIUM', 'MODERATE: Risk of hyperkalemia. Monitor potassium levels.'),
 ('LISINOPRIL', 'SPIRONOLACTONE', 'MODERATE: Additive hyperkalemia risk. Monitor electrolytes.'),
 ('LISINOPRIL', 'NSAID', 'MODERATE: NSAIDs may reduce ACE inhibitor efficacy and increase renal risk.'),
 ('SIMVASTATIN', 'AMIODARONE', 'MAJOR: Increased risk of rhabdomyolysis. Limit simvastatin to 20mg.'),
 ('SIMVASTATIN',
  'CLARITHROMYCIN',
  'MAJOR: Significantly increases statin levels. Suspend statin during therapy.'),
 ('SIMVASTATIN', 'GRAPEFRUIT', 'MODERATE: Increases statin absorption. Avoid large quantities.'),
 ('DIGOXIN', 'AMIODARONE', 'MAJOR: Increases digoxin levels by 70-100%. Reduce digoxin dose.'),
 ('DIGOXIN', 'VERAPAMIL', 'MAJOR: Increases digoxin levels. Monitor levels closely.'),
 ('DIGOXIN', 'FUROSEMIDE', 'MODERATE: Hypokalemia increases digoxin toxicity risk. Monitor K+.'))

# Table: allowed values, required columns, longest texts, unique keys (fixed values).
CONSTRAINTS = {'patients': ({'Gender': ('M', 'F', 'U'), 'PatientStatus': ('ACTIVE', 'INACTIVE', 'DECEASED', 'MERGED')},
              ['MRN', 'FirstName', 'LastName', 'DateOfBirth', 'Gender'],
              {'MRN': 20, 'SSN': 11, 'FirstName': 50, 'LastName': 50},
              ['PatientID', 'MRN']),
 'encounters': ({'EncounterType': ('INPATIENT', 'OUTPATIENT', 'EMERGENCY', 'OBSERVATION'),
                 'EncounterStatus': ('ACTIVE', 'DISCHARGED', 'CANCELLED', 'PREADMIT')},
                ['PatientID', 'EncounterType', 'AdmitDate'],
                {'EncounterNumber': 20, 'RoomNumber': 10},
                ['EncounterID', 'EncounterNumber']),
 'orders': ({'OrderType': ('LAB', 'RADIOLOGY', 'MEDICATION', 'DIET', 'CONSULT', 'PROCEDURE'),
             'OrderPriority': ('STAT', 'URGENT', 'ROUTINE', 'TIMED'),
             'OrderStatus': ('ORDERED', 'IN_PROGRESS', 'COMPLETED', 'CANCELLED', 'DISCONTINUED')},
            ['EncounterID', 'PatientID', 'OrderType'],
            {'OrderCode': 20},
            ['OrderID']),
 'medications': ({'MedicationStatus': ('ACTIVE', 'COMPLETED', 'DISCONTINUED', 'ON_HOLD')},
                 ['EncounterID', 'PatientID', 'DrugName'],
                 {'DrugName': 200},
                 ['MedicationID']),
 'lab_results': ({'ResultStatus': ('PRELIMINARY', 'FINAL', 'CORRECTED', 'CANCELLED')},
                 ['PatientID', 'TestCode'],
                 {'TestCode': 20, 'AbnormalFlag': 5},
                 ['LabResultID']),
 'diagnoses': ({'DiagnosisType': ('ADMITTING', 'PRIMARY', 'SECONDARY', 'WORKING')},
               ['ICDCode'],
               {'ICDCode': 10},
               ['DiagnosisID']),
 'allergies': ({'AllergyType': ('DRUG', 'FOOD', 'ENVIRONMENTAL', 'LATEX', 'CONTRAST'),
                'Severity': ('MILD', 'MODERATE', 'SEVERE', 'LIFE_THREATENING')},
               ['PatientID', 'AllergenName'],
               {'AllergenName': 200},
               ['AllergyID']),
 'audit_log': ({}, ['TableName', 'Action'], {'Action': 10}, ['AuditLogID']),
 'billing_audit': ({}, ['TableName', 'Action'], {'Action': 20}, ['AuditID']),
 'billing_charges': ({'ChargeStatus': ('POSTED', 'BILLED', 'PAID', 'ADJUSTED', 'VOIDED', 'TRANSFERRED')},
                     ['EncounterID', 'ChargeCode', 'ChargeAmount'],
                     {'CPTCode': 10},
                     ['ChargeID']),
 'insurance_claims': ({'ClaimStatus': ('CREATED',
                                       'SUBMITTED',
                                       'ACKNOWLEDGED',
                                       'ADJUDICATED',
                                       'PAID',
                                       'PARTIAL_PAID',
                                       'DENIED',
                                       'APPEALED',
                                       'VOIDED')},
                      ['EncounterID', 'ClaimNumber'],
                      {'ClaimNumber': 20},
                      ['ClaimID', 'ClaimNumber']),
 'payments': ({'PaymentStatus': ('POSTED', 'APPLIED', 'VOIDED', 'REFUNDED')},
              ['PatientID', 'PaymentAmount'],
              {},
              ['PaymentID']),
 'invoices': ({'InvoiceStatus': ('OPEN', 'PAID', 'PARTIAL', 'COLLECTIONS', 'WRITTEN_OFF', 'VOIDED')},
              ['PatientID', 'InvoiceNumber'],
              {'InvoiceNumber': 20},
              ['InvoiceID', 'InvoiceNumber']),
 'procedures': ({'ProcedureStatus': ('SCHEDULED', 'IN_PROGRESS', 'COMPLETED', 'CANCELLED')},
                ['EncounterID', 'CPTCode'],
                {'CPTCode': 10},
                ['ProcedureID']),
 'clinical_notes': ({'NoteStatus': ('DRAFT', 'SIGNED', 'COSIGNED', 'AMENDED', 'ADDENDED')},
                    ['EncounterID', 'AuthorID'],
                    {},
                    ['NoteID']),
 'radiology_studies': ({'StudyStatus': ('ORDERED',
                                        'SCHEDULED',
                                        'IN_PROGRESS',
                                        'COMPLETED',
                                        'DICTATED',
                                        'FINAL',
                                        'CANCELLED')},
                       ['EncounterID', 'PatientID'],
                       {},
                       ['StudyID']),
 'room_assignments': ({'AssignmentStatus': ('ACTIVE', 'TRANSFERRED', 'DISCHARGED', 'CANCELLED')},
                      ['EncounterID', 'RoomID'],
                      {},
                      ['AssignmentID']),
 'staff_schedules': ({'ShiftType': ('DAY', 'EVENING', 'NIGHT', 'ON_CALL', 'SPLIT'),
                      'ScheduleStatus': ('SCHEDULED', 'CONFIRMED', 'CANCELLED', 'CALLED_OFF', 'SWAPPED')},
                     [],
                     {},
                     ['ScheduleID']),
 'waiting_list': ({'WaitListStatus': ('WAITING', 'NOTIFIED', 'SCHEDULED', 'CANCELLED', 'EXPIRED')},
                  [],
                  {},
                  ['WaitListID']),
 'payment_plans': ({'PlanStatus': ('ACTIVE', 'COMPLETED', 'DEFAULTED', 'CANCELLED')},
                   ['PatientID'],
                   {},
                   ['PaymentPlanID']),
 'collections': ({'CollectionStatus': ('ACTIVE', 'RECOVERED', 'WRITTEN_OFF', 'RECALLED')},
                 ['InvoiceID'],
                 {},
                 ['CollectionID']),
 'chargemaster': ({},
                  ['ChargeCode', 'ChargeDescription', 'StandardCharge', 'EffectiveDate'],
                  {'ChargeCode': 20, 'ChargeDescription': 500},
                  [('ChargeCode', 'EffectiveDate')]),
 'rooms': ({'RoomType': ('EXAM',
                         'OR',
                         'PROCEDURE',
                         'IMAGING',
                         'CONFERENCE',
                         'OFFICE',
                         'ICU',
                         'NICU',
                         'ED_BAY')},
           ['RoomNumber'],
           {'RoomNumber': 10},
           ['RoomID', 'RoomNumber']),
 'appointments': ({'AppointmentType': ('NEW_PATIENT',
                                       'FOLLOW_UP',
                                       'PROCEDURE',
                                       'CONSULT',
                                       'URGENT',
                                       'TELEHEALTH',
                                       'LAB',
                                       'IMAGING'),
                   'AppointmentStatus': ('SCHEDULED',
                                         'CONFIRMED',
                                         'CHECKED_IN',
                                         'ROOMED',
                                         'IN_PROGRESS',
                                         'COMPLETED',
                                         'CANCELLED',
                                         'NO_SHOW',
                                         'RESCHEDULED')},
                  ['PatientID', 'PhysicianID'],
                  {},
                  ['AppointmentID'])}
