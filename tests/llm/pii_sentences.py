"""Sentences written for the test alone: their wording is neither made by the operator nor found in the tables.

A case stands in double brackets; a line without brackets holds none of its kind.
"""

NAME = """
The keynote was given by [[Margaret Holloway]] to a full room.
Our landlord, [[Mr. Pettigrew]], refuses to fix the boiler.
Nobody remembers whether [[Tobias Lindqvist]] paid his share.
[[Dr. Amara Okafor]] prescribed a lower dose.
Photo by [[J. Whitcombe]], used with permission.
I ran into [[Priya Raman]] at the airport yesterday.
Invite [[Gustav H. Brandt]] and his wife as well.
[[Nguyen, Linh]] has not handed in the essay.
The judge reminded [[Ms Castellanos]] of her rights.
Minutes taken by [[Oliver Strand]] on behalf of the board.
Is [[Professor Dumitrescu]] still teaching on Fridays?
Say hi to [[Fiona McAllister]] when you see her.
Hat [[Frau Wiesner]] den Vertrag schon unterschrieben?
Gestern hat mir [[Lukas Hartmann]] das Fahrrad geliehen.
Die Rede von [[Herrn Obermeier]] dauerte zwei Stunden.
Meine Tante heißt [[Gertrud Salzmann]] und backt gern.
[[Madame Lefèvre]] arrive toujours en retard.
Le dossier est suivi par [[Camille Rousseau]] depuis mars.
Hier soir, [[Étienne Marchand]] a perdu ses clés.
La profesora [[Inés Villanueva]] corrigió los exámenes.
Ayer llamó [[Rodrigo Quintero]] para cancelar la cita.
[[Sra. Montalbán]] recogerá el paquete mañana.
My dentist is [[Dr Feldstein]] and she is great.
We hired [[Samuel Adeyemi]] as a plumber.
The winner, [[Katarzyna Nowak]], could not attend.
Have you read anything by [[Ursula van Dijk]] lately?
[[Hiroshi Tanaka]] scored twice before half time.
This sweater was knitted by [[Ingeborg Solheim]] herself.
Ask for [[Beatriz Fonseca]] at the front desk.
[[Declan O’Rourke]] plays the fiddle on Sundays.
The Royal Opera House was closed for repairs.
They hiked along the Blue Ridge Parkway all day.
She works for the Global Shipping Alliance in Rotterdam.
The Quarterly Earnings Report is due soon.
An article in the Evening Standard started it.
The Second World War ended decades earlier.
We booked a table at the Golden Dragon Restaurant.
Every spring the Cherry Blossom Festival draws crowds.
The Supreme Court rejected the appeal.
He lost his wallet near Victoria Station.
The Northern Lights were visible last night.
Open the Control Panel and pick a theme.
The Great Barrier Reef is shrinking.
Die Deutsche Bahn hat wieder Verspätung.
Das Brandenburger Tor wird renoviert.
Le Petit Journal paraît chaque semaine.
El Banco Central subió los tipos.
The annual Book Fair takes place in autumn.
Their flight leaves from Terminal Two at dawn.
the default Power Settings drain the battery
We thanked [[Leonora Achterberg]] for the flowers.
[[Captain Jonas Weatherby]] took the wheel.
The Annual General Meeting was postponed.
"""

PHONE = """
You can ring the clinic on [[020 8123 4567]] before noon.
Leave a voicemail at [[(415) 555-2671]] any time.
His new cell is [[646-555-0199]], the old one is dead.
For bookings dial [[+44 161 496 0123]].
Our hotline [[0800 123 4567]] is free of charge.
Text me at [[07911 123456]] once you land.
Handy: [[0152 28817386]]
Telefonisch erreichen Sie uns unter [[+49 89 636 48018]].
Büro: [[040/4287-3001]], nur vormittags.
Mein Festnetz ist [[0221 9876543]].
Tél. [[01 42 68 53 00]]
Appelle-moi au [[06 12 34 56 78]] après le boulot.
Le standard répond au [[+33 4 91 13 89 00]].
Mi teléfono es [[612 34 56 78]].
Llámame al [[+34 915 123 456]] esta tarde.
Call the office, [[212.555.0187]], and ask for help.
Contact number [[+1 303-555-0148]] is monitored daily.
His landline, [[01632 960983]], rings forever.
Reach the porter on [[0131 496 0777]] at night.
WhatsApp works too: [[+39 347 1234567]]
Emergency contact is [[(702) 555-0134]].
Fax it to [[+41 44 668 18 00]], they still use paper.
The helpdesk answers [[1-888-555-0123]] around the clock.
sms an [[0664 1234567]] reicht
phone [[2025550173]] for details
The library holds 1 250 000 volumes.
We released build 2023.11.4821 on Monday.
The meeting is on 2024-03-18 at 14:30.
Payment of 12 500 000 pesos was refused.
Ping 10.0.12.255 to see if it is up.
The book, ISBN 978-1-4028-9462-6, is out of print.
Case 2023-4417-09 was closed without comment.
See lines 1450-1985 of the log.
Our fiscal year is 2023-2024.
Article number 4007817327098 is sold out.
The satellite orbits at 35 786 km.
Serial AX-2041-7781 is affected.
She was born on 14.08.1987 in Graz.
Order 114-3941689-8772232 has shipped.
Set the timeout to 1500000 and retry.
"""

ID_NUMBER = """
Her social security number is [[219-09-9999]], please update it.
The form lists SSN [[078-05-1120]] for the applicant.
He gave his SSN as [[457 55 5462]].
My passport is [[P4366918]] and expires soon.
Passport number [[C3045892]] was reported stolen.
Pass-Nr. [[C01X0006H]] liegt bei
Ihr Personalausweis hat die Nummer [[L01X00T471]].
Mein Reisepass: [[CF4TVJ88M]]
National Insurance number [[QQ 12 34 56 C]] is missing.
NINO [[AB123456C]] belongs to the new clerk.
DNI [[45678912S]], expedido en Sevilla
El NIE del inquilino es [[X1234567L]].
Su documento de identidad, [[12345678Z]], caducó.
NIR [[1 85 07 75 116 004 21]]
Numéro de sécurité sociale [[2 69 05 49 588 157 80]]
personnummer [[811228-9874]]
The tenant’s identity card reads [[AX4521987]].
codice fiscale [[RSSMRA85T10A562S]]
PESEL [[44051401359]]
AHV [[756.9217.0769.85]]
The security guard copied my ID, [[533-28-1904]].
Photo of passport [[X5512034]] attached.
BSN [[111222333]]
rijksregister [[85.07.30-033.28]]
identity number [[640823-3234]] was entered twice
Invoice 2023-118845 is overdue.
The commit 9fceb02d broke the build.
Part no. BX-7731-004 does not fit.
Ticket 8812-4410-07 was merged.
The checksum is 5D41402ABC4B2A76.
ISBN 0-306-40615-2 was reprinted.
Room B1204 is on the twelfth floor.
The lot sold for 18 500 000 euros.
Flight LH4521987 does not exist.
They met on 1999-12-31 for the party.
Use port 50070 for the dashboard.
The host 172.16.254.1 is unreachable.
Rows 4012-4980 were skipped.
her SSN ([[512-44-0098]]) leaked
"""

ADDRESS = """
The parcel went to [[48 Larkspur Avenue]] by mistake.
Please deliver it to [[7 Kensington Church Street]], first floor.
She grew up at [[1425 Maple Drive, Springfield]].
Our new office: [[300 Harbour Boulevard]]
He rents a flat at [[9 Old Mill Lane]].
The crash happened outside [[61 Queens Road]].
Mail your form to [[2200 N Lakeshore Drive]].
Meet the agent at [[15A Priory Terrace, Bath]] at ten.
Ich wohne in der [[Goethestraße 17]].
Bitte schicken Sie es an die [[Bahnhofstr. 5, 80335 München]].
Treffpunkt ist [[Kastanienallee 82]], Hinterhof.
Die Praxis liegt [[Am Stadtpark 3]].
Rechnung an [[Rosenweg 11a]]
Le cabinet se trouve [[24 rue Victor Hugo]], au fond.
Livrez au [[8 bis avenue de la République]] svp.
Il habite [[112, boulevard Voltaire]] à Paris.
Vivo en la [[Calle Mayor 22]], segundo piso.
La oficina está en [[Avenida de América 37]].
Su taller queda en [[Plaza del Carmen, 6]].
Abita in [[Via Garibaldi 14]].
Kantoor: [[Prinsengracht 263]]
Her studio is at [[530 Sycamore Court]].
The keys are at [[19 Beech Grove]].
Forward everything to [[77 Wellington Road, Leeds]].
Lieferadresse: [[Schillerplatz 4, 70173 Stuttgart]]
They walked down Regent Street for hours.
Ring twice at [[5 Abbey Close, Norwich]].
Sie zog in die [[Lindenstrasse 40]] um.
Chapter 12 Great Expectations is short.
There are 45 Dutch and Belgian teams.
The 1984 Summer Olympics were in Los Angeles.
Bake it for 30 Minutes Exactly.
Table 4 Annual Rainfall lists the totals.
Die Hauptstraße war gesperrt.
Il a traversé la rue Mouffetard.
We saw 200 Canada Geese at the pond.
Room 12 Green Wing is occupied.
He owns 3 Harley Davidson motorcycles.
La Calle Mayor estaba vacía.
"""

EMAIL = """
Drop a line to [[harriet.bloom@northpost.co.uk]] about the lease.
My work mail is [[t.okoye@lumenworks.io]].
Bitte an [[info@gartenbau-huber.at]] senden.
Réponses à [[secretariat@lycee-jaures.fr]] avant vendredi.
Escríbeme a [[paula_rios88@correo.es]] cuando puedas.
[[SALES@BRIGHTTILES.COM]] never answers.
Ping me: [[kim+lists@fastmail.net]]
To hide from bots: [[sven (at) bergstrom (dot) se]]
Use [[nora [at] tidepool [dot] org]] instead.
it is [[mika at sampo dot fi]], spelled out
[[office@st-anne.school]] is the school office.
Please unsubscribe [[old.account@mailbox.org]] from this list.
The invoice was sent by [[billing@cloudnest.com]] twice.
cc: [[a.b@c.example]]
He signs as <[[dmitri@orlov.net]]>.
mailto:[[press@harvestmoon.fm]]
Her address, [[ffion.rees@cymru.wales]], bounced.
Schreib an [[anfragen(at)tischler-kunz.de]] bitte.
Contact [[helpdesk {at} uni-x.edu]] on weekdays.
Let us meet at noon at the usual bar.
The prompt said deploy@web01:~/app$ and hung.
Clone git@hub.example.org:team/tools.git first.
Mention @quietfox in the thread.
She looked at Dot and laughed.
We sell them at 3.50 each.
Install @scope/button@2.4.1 today.
Bug reports belong to [[bugs@kitewerks.dev]] only.
He stared at everything.
They arrived at York. Dot was waiting.
"""

SENTENCES = {"name": NAME, "phone": PHONE, "id_number": ID_NUMBER, "address": ADDRESS, "email": EMAIL}
