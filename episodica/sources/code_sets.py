"""Code sets of the pregnancy worklist. All are fixed values, matched exactly unless named a prefix."""

# Occupations (prefixes)
COHORT_OCCUPATIONS = ["2231", "2235", "2251", "2252", "2253"]
TEST_OCCUPATIONS = ["2231", "2235", "2251", "2252", "2253", "3222"]
DENTAL_OCCUPATIONS = ["2232"]

# Problems that put an attendance into the cohort
COHORT_CIAP = ["ABP001", "W03", "W05", "W29", "W71", "W78", "W79", "W80", "W81", "W84", "W85"]
COHORT_CID = """
O00 O009 O10 O11 O12 O120 O121 O122 O13 O14 O140 O141 O149 O15 O150 O151 O159 O16
O20 O200 O208 O209 O21 O210 O211 O212 O218 O219 O22 O220 O221 O222 O223 O224 O225 O228 O229
O23 O230 O231 O232 O233 O234 O235 O239 O24 O240 O241 O242 O243 O244 O249 O25
O26 O260 O261 O263 O264 O265 O268 O269 O28 O280 O281 O282 O283 O284 O285 O288 O289
O29 O290 O291 O292 O293 O294 O295 O296 O298 O299 O30 O300 O301 O302 O308 O309
O31 O311 O312 O318 O32 O320 O321 O322 O323 O324 O325 O326 O328 O329
O33 O330 O331 O332 O333 O334 O335 O336 O337 O338 O339 O34 O340 O341 O342 O343 O344 O345 O346 O347 O348 O349
O35 O350 O351 O352 O353 O354 O355 O356 O357 O358 O359 O36 O360 O361 O362 O363 O365 O366 O367 O368 O369
O40 O41 O410 O411 O418 O419 O43 O430 O431 O438 O439 O44 O440 O441 O46 O460 O468 O469 O47 O470 O471 O479 O48
O752 O753 O98 O990 O991 O992 O993 O994 O995 O996 O997
Z321 Z33 Z34 Z340 Z348 Z349 Z35 Z350 Z351 Z352 Z353 Z354 Z357 Z358 Z359 Z36 Z640
""".split()

# Problems that record a loss or a birth
LOSS_CIAP = ["W82", "W83"]
LOSS_CID = ["O02", "O03", "O04", "O05", "O06", "Z303"]
BIRTH_CIAP = ["W90", "W91", "W92", "W93"]
BIRTH_CID = """
O42 O45 O60 O61 O62 O63 O64 O65 O66 O67 O68 O69 O70 O71 O73 O750 O751 O754 O755 O756 O757 O758 O759
O80 O81 O82 O83 O84 Z370 Z371 Z372 Z375 Z379 Z38 Z39
""".split()

# Procedures that record a test: standalone, or evaluated in an attendance
HIV_STANDALONE = ["0214010040", "0214010058", "ABPG024"]
HIV_EVALUATED = ["0202030300", "ABEX018"]
SYPHILIS_STANDALONE = ["0214010074", "0214010082", "ABPG026"]
SYPHILIS_EVALUATED = ["0202031110", "0202031179", "ABEX019"]

# "Not informed"
NO_CODE = "-"
NO_UNIT_NAME = "Não informado"
NO_TEAM_NAME = "SEM EQUIPE"
NO_ADDRESS = ", "
